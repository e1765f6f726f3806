from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.functions.columns import first_non_nulls, order_key
from ledgerlint.operators import checks, cleaning as c
from ledgerlint.sources.schema import LINE_SCHEMA
from tests.helpers import FIVE, column, five, line, lines

NAN = math.nan


def test_config_from_upper_case_keys():
    config = CleaningConfig.from_mapping({"DROP_MISSING_ID": False, "PRICE_CAP_Q": 0.9})
    assert (config.drop_missing_id, config.price_cap_q) == (False, 0.9)


def test_exact_duplicates(spark):
    df = lines(spark, [line(r) for r in FIVE] + [line(FIVE[0])])
    assert c.drop_exact_duplicates(df).count() == 5


def test_exact_duplicates_keep_other_source_year_unless_excluded(spark):
    df = lines(spark, [line(), line(source_year="2010-2011")])
    assert c.drop_exact_duplicates(df).count() == 2
    assert c.drop_exact_duplicates(df, exclude=["source_year"]).count() == 1


def test_collapse_sums_quantity(spark):
    df = lines(spark, [line(r) for r in FIVE] + [line(FIVE[0], quantity=5)])
    out = c.collapse_lines(df)
    assert out.count() == 5
    assert column(out.where("invoice = '489434'"), "quantity") == [7]


def test_collapse_takes_first_non_null_per_column(spark):
    df = lines(
        spark,
        [
            line(day=2, description="later", customer_id="2", country=None),
            line(day=1, description=None, customer_id="1", country=None),
            line(day=3, description="last", customer_id="3", country="France"),
        ],
    )
    row = c.collapse_lines(df).first()
    assert (row.description, row.customer_id, row.country) == ("later", "1", "France")
    assert row.invoicedate == dt.datetime(2010, 6, 2)


def test_collapse_drops_null_keys_and_sums_nulls_to_zero(spark):
    df = lines(spark, [line(invoice=None), line(stockcode=None), line(quantity=None)])
    assert column(c.collapse_lines(df), "quantity") == [0]


def test_collapse_carries_extra_columns(spark):
    df = lines(spark, [line(), line(quantity=3)]).withColumn("extra", F.lit("x"))
    assert column(c.collapse_lines(df), "extra") == ["x"]


def test_technical(spark):
    assert c.drop_technical(five(spark)).count() == 4
    out = c.drop_technical(five(spark, description="MANUAL ADJUSTMENT"))
    assert out.count() == 3


@pytest.mark.parametrize("text", ["LATEST", "Contest", "adjustable", "Manual"])
def test_technical_is_unanchored_in_any_case(spark, text):
    assert c.drop_technical(lines(spark, [line(description=text)])).count() == 0


def test_technical_keeps_nulls(spark):
    df = lines(spark, [line(description=None, quantity=None), line(quantity=-1000)])
    assert c.drop_technical(df).count() == 1


def test_extreme_price(spark):
    assert c.drop_extreme_price(five(spark)).count() == 4
    df = lines(spark, [line(price=None), line(price=10000.0)])
    assert column(c.drop_extreme_price(df), "price") == [10000.0]


def test_zero_price(spark):
    assert c.drop_zero_price(five(spark)).count() == 4
    assert c.drop_zero_price(five(spark, invoice="C489438")).count() == 5
    assert c.drop_zero_price(lines(spark, [line(price=None)])).count() == 1


def test_credit_prefix(spark):
    df = lines(
        spark,
        [
            line(invoice="489999", quantity=-1),
            line(invoice="489999", quantity=-2),
            line(invoice="490000", quantity=3),
            line(invoice="490001", quantity=-3),
            line(invoice="490001", quantity=None),
            line(invoice="C490002", quantity=-1),
        ],
    )
    out = c.fix_credit_prefix(df)
    assert sorted(column(out, "invoice")) == [
        "490000", "490001", "490001", "C489999", "C489999", "C490002",
    ]
    assert out.columns == df.columns


def test_negative_sales(spark):
    df = lines(
        spark,
        [
            line(invoice="489999", quantity=-1),
            line(invoice="C490000", quantity=-2),
            line(invoice="490001", quantity=3),
            line(invoice="490002", quantity=None),
        ],
    )
    assert sorted(column(c.drop_negative_sales(df), "invoice")) == [
        "490001", "490002", "C490000",
    ]


def test_filters_reach_the_scan(spark, tmp_path):
    five(spark).write.parquet(str(tmp_path / "five"))
    stored = spark.read.parquet(str(tmp_path / "five"))

    def pushed(step):
        plan = step(stored)._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: ")[1].split("], ReadSchema")[0]

    assert "LessThanOrEqual(price,10000.0)" in pushed(c.drop_extreme_price)
    assert "StringStartsWith(invoice,C)" in pushed(c.drop_zero_price)
    assert "GreaterThanOrEqual(quantity,0)" in pushed(c.drop_negative_sales)
    assert "In(quantity, [-1000,1000])" in pushed(c.drop_technical)
    assert "IsNotNull(customer_id)" in pushed(c.drop_missing_customer)


def test_null_invoices_are_sales(spark):
    df = lines(spark, [line(invoice=None, price=0.0, quantity=-1)])
    assert c.drop_zero_price(df).count() == c.drop_negative_sales(df).count() == 0


def test_missing_customer(spark):
    assert c.drop_missing_customer(five(spark)).count() == 4
    out = c.impute_missing_customer(five(spark))
    assert column(out.where("missing_id = 1"), "customer_id") == ["anon_germany"]
    df = lines(
        spark,
        [line(customer_id=None), line(customer_id=None, country=None)],
    )
    assert sorted(column(c.impute_missing_customer(df), "customer_id")) == [
        "anon_united kingdom", "anon_unknown",
    ]


def test_basket_value(spark):
    out = c.add_basket_value(five(spark))
    assert column(out, "basket_value") == [21.0, 20000.0, 0.0, 30001.5, 0.0]
    assert column(c.add_basket_value(lines(spark, [line(quantity=None)])), "basket_value") == [0.0]


def _valued(spark, rows):
    return spark.createDataFrame(rows, "invoice string, price double, basket_value double")


def test_caps_bound_all_values(spark):
    rows = [(str(i), 1.0 + i, 10.0 + 10 * i) for i in range(100)]
    df = _valued(spark, rows)
    caps = c.cap_thresholds(df, CleaningConfig())
    assert caps["price_cap"] == pytest.approx(1 + 99 * 0.99)
    assert caps["basket_cap"] == pytest.approx(10 + 990 * 0.995)
    top = c.apply_caps(df, caps).agg(F.max("price"), F.max("basket_value")).first()
    assert tuple(top) == (caps["price_cap"], caps["basket_cap"])
    counts = c.capped_counts(df, caps).first()
    assert (counts.price_capped_count, counts.basket_capped_count) == (1, 1)


def test_caps_ignore_credit_lines_but_apply_to_them(spark):
    rows = [(f"C{i}", 1000.0, 5000.0) for i in range(50)]
    rows += [(str(i), 1.0 + i, 1.0 + i) for i in range(50)]
    df = _valued(spark, rows)
    caps = c.cap_thresholds(df, CleaningConfig())
    assert caps["price_cap"] < 1000 and caps["basket_cap"] < 5000
    credit = c.apply_caps(df, caps).where("invoice like 'C%'")
    assert set(column(credit, "price")) == {caps["price_cap"]}


def test_caps_without_sales_leave_values(spark):
    df = _valued(spark, [("C1", 5.0, 5.0)])
    caps = c.cap_thresholds(df, CleaningConfig())
    assert caps == {"price_cap": None, "basket_cap": None}
    assert column(c.apply_caps(df, caps), "price") == [5.0]


def test_country_bucket(spark):
    names = [None, "United Kingdom", "EIRE", "eire", "Channel Islands", "Japan"]
    df = lines(spark, [line(country=n) for n in names])
    assert column(c.add_country_bucket(df), "country_bucket") == [
        "Unknown", "UK", "EU", "NonEU", "EU", "NonEU",
    ]


def test_is_cancelled(spark):
    assert column(c.add_is_cancelled(five(spark)), "is_cancelled") == [0, 0, 1, 0, 0]
    lower = lines(spark, [line(invoice="c1"), line(invoice=None)])
    assert column(c.add_is_cancelled(lower), "is_cancelled") == [0, 0]


def _violations(df, **bounds):
    table = checks.final_assertions(df, CleaningConfig(**bounds))
    return {r["check"]: r["violations"] for r in table.collect()}


def test_final_assertions(spark):
    good = lines(spark, [line(), line(stockcode="2"), line(price=None, stockcode="3")])
    assert set(_violations(good).values()) == {0}
    checks.enforce(checks.final_assertions(good, CleaningConfig()))
    bad = lines(
        spark,
        [
            line(), line(),
            line(price=0.0, stockcode="2"),
            line(invoice="C1", price=0.0),
            line(stockcode="3", invoicedate=dt.datetime(2008, 1, 1)),
            line(stockcode="4", day=None),
            line(stockcode="5", invoicedate=dt.datetime(2011, 12, 9, 23, 59, 59)),
        ],
    )
    assert _violations(bad) == {
        "unique_invoice_stockcode": 1, "positive_sale_price": 1, "date_in_range": 2,
    }
    with pytest.raises(ValueError, match="unique_invoice_stockcode"):
        checks.enforce(checks.final_assertions(bad, CleaningConfig()))


def test_load_checks(spark):
    table = {r["check"]: r for r in checks.load_checks(five(spark), "y").collect()}
    assert not table["enough_rows"].passed and table["enough_rows"].severity == "warning"
    assert table["usual_years"].observed == "2010-2010"
    with pytest.warns(UserWarning, match="enough_rows"):
        checks.enforce(checks.load_checks(five(spark), "y"))


@pytest.mark.parametrize(
    "change, failed",
    [
        (lambda d: d.drop("quantity"), "required_columns"),
        (lambda d: d.limit(0), "not_empty"),
        (lambda d: d.withColumn("invoice", F.lit(None).cast("string")), "invoice_not_all_null"),
    ],
)
def test_load_checks_raise(spark, change, failed):
    with pytest.raises(ValueError, match=failed):
        checks.enforce(checks.load_checks(change(five(spark)), "y"))


def test_load_checks_on_unusual_dates(spark):
    df = five(spark).withColumn("invoicedate", F.lit("not a date"))
    failed = checks.load_checks(df, "y").where("not passed")
    assert set(column(failed, "check")) == {"enough_rows", "some_valid_date"}
    old = five(spark).withColumn("invoicedate", F.lit("1999-01-01"))
    assert "usual_years" in column(checks.load_checks(old, "y").where("not passed"), "check")


def test_schema_match(spark):
    df = five(spark)
    assert checks.schema_match(df, df, "all").first().passed
    assert checks.schema_match(df, df.drop("price"), "all").first().observed == "price"


def test_collapse_takes_first_values_of_rows_with_and_without_nulls(spark):
    rng = random.Random(5)
    pick = lambda *values: rng.choice([None, *values])
    rows = [
        line(invoice=f"i{rng.randrange(40)}", stockcode=f"s{rng.randrange(3)}", day=pick(1, 2), price=pick(1.0, 2.0),
             description=pick("a", "b"), customer_id=pick("1", "2"), country=pick("x", "y"),
             quantity=pick(1, 2), source_year=rng.choice(["p", "q"]))
        for _ in range(600)
    ]
    got = {(r["invoice"], r["stockcode"]): r for r in c.collapse_lines(lines(spark, rows)).collect()}
    order = order_key(LINE_SCHEMA.fieldNames(), exclude=("invoice", "stockcode"))
    groups = {}
    for r in rows:
        r = dict(zip(LINE_SCHEMA.fieldNames(), r))
        groups.setdefault((r["invoice"], r["stockcode"]), []).append(r)
    assert got.keys() == groups.keys()
    for key, held in groups.items():
        for name in order:
            if name == "quantity":
                want = sum(r[name] or 0 for r in held)
            else:
                prefix = order[: order.index(name) + 1]
                some = [[(r[x] is not None, r[x]) for x in prefix] for r in held if r[name] is not None]
                want = min(some)[-1][1] if some else None
            assert got[key][name] == want, (key, name)


def test_a_line_without_nulls_is_carried_once(spark):
    """A prefix for each column would carry its first columns as often as there are columns."""
    columns = [c for c in LINE_SCHEMA.fieldNames() if c not in ("invoice", "stockcode", "quantity")]
    order = order_key(LINE_SCHEMA.fieldNames(), exclude=("invoice", "stockcode"))
    aggregates, _ = first_non_nulls(columns, order)
    whole, holed = five(spark).limit(1), five(spark, customer_id=None).where("customer_id IS NULL").limit(1)
    for frame, n in ((whole, 1), (holed, len(columns) - 1)):
        row = frame.agg(*(a.alias(name) for name, a in aggregates.items())).first()
        assert sum(v is not None for v in row) == n
