from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlint.config import WATERFALL_STEPS, CleaningConfig
from ledgerlint.operators.waterfall import label_lines, loss_totals, waterfall
from ledgerlint.plans.cleaning_run import run_cleaning, save_run
from ledgerlint.plans.profile_run import run_profile, save_profile
from ledgerlint.plans.queries import CONFIG, QUERIES
from ledgerlint.sources import fixture
from ledgerlint.sources.staging import stage, staging_dir
from tests.helpers import line, lines

# Rows remaining after each step, from FIXTURES.md.
EXPECTED = {
    "sf0.001": [6067, 5942, 5745, 5478, 5457, 5435, 4040, 4040],
    "sf0.01": [60696, 59773, 57752, 55032, 54802, 54628, 41000, 41000],
}
CAPS = {"sf0.001": (9894.53146, 460916.69174), "sf0.01": (9907.03325, 459448.359)}


@pytest.mark.parametrize("sf", EXPECTED)
def test_waterfall_of_the_fixture(spark, sf):
    rows = QUERIES["waterfall"](spark, f"/root/testdata/{sf}").orderBy("step_no").collect()
    assert [r.step for r in rows] == list(WATERFALL_STEPS)
    assert [r.rows_remaining for r in rows] == EXPECTED[sf]
    for before, after in zip(rows, rows[1:]):
        assert before.rows_remaining - after.rows_removed == after.rows_remaining


@pytest.mark.parametrize("sf", EXPECTED)
def test_run_agrees_with_its_accounts(spark, sf, tmp_path):
    run = run_cleaning(fixture.transactions(spark, f"/root/testdata/{sf}"), CONFIG)
    assert run.cleaned.count() == EXPECTED[sf][-1]
    caps = run.caps.first()
    assert (caps.price_cap, caps.basket_cap) == pytest.approx(CAPS[sf])
    summary = {r.metric: r.value for r in run.summary.collect()}
    assert summary["final_rows"] == EXPECTED[sf][-1]
    assert summary["initial_rows"] == EXPECTED[sf][0]
    save_run(run, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out" / "orders_clean"))
    assert stored.count() == EXPECTED[sf][-1]
    assert stored.agg(F.max("price")).first()[0] == caps.price_cap
    written = spark.read.csv(str(tmp_path / "out" / "row_loss_waterfall"), header=True)
    assert written.count() == len(WATERFALL_STEPS)


def test_labels_cover_null_keys_and_repaired_invoices(spark):
    rows = [
        line(), line(),                                   # exact duplicate
        line(quantity=7),                                 # collapses into the first
        line(invoice=None),                               # no key
        line(invoice="2", quantity=-1), line(invoice="2", stockcode="b", quantity=-2,
                                             customer_id=None),  # repaired
        line(invoice="3", quantity=-1, customer_id=None),
        line(invoice="3", stockcode="b", quantity=2, customer_id=None),  # mixed
        line(invoice="4", price=None), line(invoice="5", price=0.0),
        line(invoice="C6", price=0.0, quantity=-1),
        line(invoice="7", description="a test"),
    ]
    config = CleaningConfig(isolation_contam=0.0)
    df = lines(spark, rows)
    totals = loss_totals(label_lines(df, config), config)
    assert totals.first().invoices_repaired == 1
    table = {r.step: (r.rows_remaining, r.rows_removed) for r in waterfall(totals).collect()}
    assert table == {
        "initial": (12, 0),
        "collapse_duplicates": (9, 3),
        "drop_technical": (8, 1),
        "drop_extreme_prices": (7, 1),
        "drop_zero_price": (6, 1),
        "drop_negative_non_credit": (5, 1),
        "handle_missing_id": (3, 2),
        "isolation_forest": (3, 0),
    }
    run = run_cleaning(df, config)
    assert sorted(r.invoice for r in run.cleaned.collect()) == ["489434", "C2", "C6"]

    impute = CleaningConfig(isolation_contam=0.0, drop_missing_id=False)
    run = run_cleaning(df, impute)
    assert run.cleaned.count() == 5
    assert run.waterfall.where("step = 'handle_missing_id'").first().rows_removed == 0


def test_one_whole_table_stays_staged(spark):
    folder = Path(staging_dir(spark).removeprefix("file://"))
    before = set(folder.glob("*"))
    impute = CleaningConfig(isolation_contam=0.0, drop_missing_id=False)
    rows = [line(), line(invoice="2", quantity=-1), line(invoice="3", quantity=-1), line(invoice="3", stockcode="b")]
    cleaned = run_cleaning(lines(spark, rows), impute).cleaned
    names = sorted(p.name.split("-")[0] for p in set(folder.glob("*")) - before)
    assert [n for n in names if n not in ("parts", "verdicts")] == ["labelled", "repaired"]
    assert sorted(r.invoice for r in cleaned.collect()) == ["3", "489434", "C2"]


def test_nothing_is_saved_when_an_assertion_fails(spark, tmp_path):
    run = run_cleaning(lines(spark, [line(day=None)]), CleaningConfig(isolation_contam=0.0))
    with pytest.raises(ValueError, match="date_in_range"):
        save_run(run, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_repair_may_create_a_duplicate_key_that_the_assertion_finds(spark):
    rows = [line(invoice="9", quantity=-1), line(invoice="C9", quantity=-1)]
    run = run_cleaning(lines(spark, rows), CleaningConfig(isolation_contam=0.0))
    failed = run.assertions.where("not passed").collect()
    assert [(r["check"], r["violations"]) for r in failed] == [("unique_invoice_stockcode", 1)]


def test_run_with_forest_accounts_for_outliers(spark):
    config = CleaningConfig(date_min=fixture.DATE_MIN, date_max=fixture.DATE_MAX)
    run = run_cleaning(fixture.transactions(spark, "/root/testdata/sf0.001"), config)
    last = run.waterfall.where("step = 'isolation_forest'").first()
    assert 0 < last.rows_removed <= 5
    assert run.cleaned.count() == last.rows_remaining


def test_checks_are_made_after_the_forest(spark, tmp_path):
    """One sale far from all others, alone on the last day, goes before the dates are checked."""
    keys = [k for k in range(1, 4000) if k % 20 and k % 50 != 7 and k % 40 != 11 and k % 83 and 4 <= (k + 1) % 97][:2000]
    far = keys[1000]
    day = F.when(F.col("k") == far, F.lit("2001-07-31")).otherwise(F.lit("1996-03-01")).cast("timestamp_ntz")
    orders = spark.createDataFrame([(k,) for k in keys], "k long")
    apart = F.col("k") == far
    tables = {
        "lineitem": orders.select(
            F.col("k").alias("l_orderkey"), F.lit(1).cast("long").alias("l_partkey"), F.lit(1).alias("l_linenumber"),
            F.when(apart, 90_000.0).otherwise((F.col("k") % 5 + 1).cast("double")).alias("l_quantity"),
            F.when(apart, 90_000.0).otherwise((F.col("k") % 7 + 10).cast("double")).alias("l_extendedprice"),
        ),
        "orders": orders.select(F.col("k").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), day.alias("o_orderdate")),
        "customer": spark.createDataFrame([(1, 1)], "c_custkey long, c_nationkey int"),
        "part": spark.createDataFrame([(1, "box")], "p_partkey long, p_name string"),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = {r["check"]: r for r in QUERIES["clean_orders_checks"](spark, str(tmp_path)).collect()}
    assert all(r["passed"] for r in rows.values())
    assert rows["date_in_range"]["observed"] == "1996-03-01 00:00:00 to 1996-03-01 00:00:00"


def test_profile_run_writes_every_report(spark, tmp_path):
    table = stage(fixture.transactions(spark, "/root/testdata/sf0.001"), "lines")
    reports = run_profile(table)
    save_profile(reports, str(tmp_path))
    nulls = {r.column_name: r for r in reports["null_counts"].collect()}
    uniques = {r.column_name: r for r in reports["unique_counts"].collect()}
    assert nulls.keys() == uniques.keys() == set(table.columns)
    assert {r.total_count for r in uniques.values()} == {table.count()}
    for r in nulls.values():
        assert 0 <= r.null_pct <= 100
        total = r.null_count + r.non_null_count
        assert abs(r.null_pct - 100 * r.null_count / total) < 0.01
    assert {p.name for p in tmp_path.iterdir()} == set(reports)
