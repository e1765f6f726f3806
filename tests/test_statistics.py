from __future__ import annotations

import math

from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.functions.normal import normal_quantile
from ledgerlint.functions.rank_sums import quantile_sums, sums_of_quantiles
from ledgerlint.operators import baskets, distribution, forest, monitoring, normality
from ledgerlint.operators import anomalies, profiling
from tests.helpers import column, five, line, lines


def values(spark, data, weights=None):
    rows = [("v", float(x), int(w)) for x, w in zip(data, weights or [1] * len(data))]
    return spark.createDataFrame(rows, "variable string, value double, weight long")


def test_histogram_matches_numpy(spark):
    data = np.random.default_rng(1).normal(size=3000)
    got = distribution.histogram(values(spark, data)).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=50)
    assert [r.row_count for r in got] == list(counts)
    assert [r.bin_low for r in got] == pytest.approx(list(edges[:-1]))
    assert got[-1].bin_high == data.max()


def test_histogram_of_a_constant_is_one_bin(spark):
    rows = distribution.histogram(values(spark, [4.0] * 9)).collect()
    assert [(r.bin, r.bin_low, r.bin_high, r.row_count) for r in rows] == [(0, 4.0, 4.0, 9)]


def test_log_histogram_uses_positive_values_only(spark):
    rows = distribution.histogram_log10(values(spark, [-5, 0, 1, 10, 100])).collect()
    assert sum(r.row_count for r in rows) == 3


def test_boxplot(spark):
    data = [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    row = distribution.boxplot_stats(values(spark, data)).first()
    assert (row.q1, row.median, row.q3) == (3.25, 5.5, 7.75)
    assert (row.whisker_low, row.whisker_high, row.outlier_count) == (1, 9, 1)
    weighted = distribution.boxplot_stats(values(spark, [1.0, 50], [9, 2])).first()
    assert (weighted.median, weighted.outlier_count, weighted.row_count) == (1, 2, 11)


def test_normal_quantile():
    p = np.array([1e-300, 1e-12, 0.01, 0.075, 0.2, 0.5, 0.6, 0.925, 0.99999, 1 - 1e-12])
    want = [NormalDist().inv_cdf(x) for x in p]
    assert normal_quantile(p) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_qq_of_few_values_plots_each(spark):
    data = [3.0, 1.0, 2.0, 5.0]
    rows = distribution.qq_points(values(spark, data)).orderBy("first_rank").collect()
    assert [r["sample"] for r in rows] == sorted(data)
    assert rows[0].theoretical == pytest.approx(-rows[-1].theoretical)
    assert distribution.qq_points(values(spark, [1, 2, 3])).count() == 0


def test_qq_of_normal_data_is_a_line(spark):
    data = np.random.default_rng(2).normal(10, 3, 4000)
    row = distribution.qq_points(values(spark, data)).first()
    assert row.r > 0.995
    assert (row.slope, row.intercept) == pytest.approx((3, 10), rel=0.05)


@pytest.mark.parametrize("n", [4, 31, 64, 65, 70, 1000, 300_000])
def test_sums_of_quantiles_over_runs_of_ranks(n):
    rng = np.random.default_rng(n)
    ends = [(1, n), (1, 1), (n, n), (n // 2, n // 2 + 1), (1, min(n, 40)), (max(1, n - 40), n)]
    ends += [(int(a), int(min(n, a + rng.integers(0, 1 + n // 3)))) for a in rng.integers(1, n + 1, 300)]
    ends += [(int(a), int(min(n, a + rng.integers(0, 12)))) for a in rng.integers(1, n + 1, 300)]
    u = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    u[0], u[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    z = np.array([NormalDist().inv_cdf(p) for p in u])
    for (a, b), t, tt in zip(ends, *quantile_sums(*np.array(ends).T, n)):
        part = z[a - 1 : b]
        assert t == pytest.approx(part.sum(), abs=1e-11 * max(1.0, np.abs(part).sum()))
        assert tt == pytest.approx((part * part).sum(), rel=1e-11, abs=1e-12 * len(part))


def test_runs_of_ranks_among_a_trillion():
    """Neighbouring runs add up to their union: no digits are lost to cancellation."""
    n, at = 10**12, 3 * 10**11
    rows = [(at, at + 5), (at + 6, at + 10**6), (at, at + 10**6), (1, at - 1), (1, n), (at + 10**6 + 1, n), (at + 3, at + 3)]
    for i, sums in enumerate(quantile_sums(*np.array(rows).T, n)):
        few, more, both, left, whole, right, one = sums
        assert few + more == pytest.approx(both, rel=1e-12)
        assert few / 6 == pytest.approx(one, rel=1e-10)
        assert left + both + right == pytest.approx(whole, abs=1e-3 if i == 0 else 1e-2)
    assert whole == pytest.approx(n, rel=1e-9)


def test_sums_as_a_column(spark):
    runs = spark.createDataFrame([(1, 4, 10), (5, 10, 10), (2, 90, 200)], "a long, b long, n long")
    found = runs.select(sums_of_quantiles("a", "b", "n").alias("s")).select("s.t", "s.tt").collect()
    for row, (a, b, n) in zip(found, [(1, 4, 10), (5, 10, 10), (2, 90, 200)]):
        t, tt = quantile_sums(np.array([a]), np.array([b]), n)
        assert (row.t, row.tt) == pytest.approx((t[0], tt[0]), rel=1e-14)


def test_qq_keeps_tails_and_fits_all_values(spark):
    data = np.r_[np.random.default_rng(3).lognormal(2, 1.8, 5000), [4.0] * 50]
    spots = np.array([(i - 0.3175) / (len(data) + 0.365) for i in range(1, len(data) + 1)])
    spots[[0, -1]] = 1 - 0.5 ** (1 / len(data)), 0.5 ** (1 / len(data))
    t, x = np.array([NormalDist().inv_cdf(p) for p in spots]), np.sort(data)
    slope, intercept = np.polyfit(t, x, 1)
    weighted = [(v, int((data == v).sum())) for v in np.unique(data)]
    rows = distribution.qq_points(
        values(spark, [v for v, _ in weighted], [w for _, w in weighted]).repartition(5)
    ).collect()
    assert max(r["sample"] for r in rows) == data.max() and len(rows) == len(weighted)
    assert (rows[0].slope, rows[0].intercept) == pytest.approx((slope, intercept), rel=1e-9)
    assert rows[0].r == pytest.approx(np.corrcoef(t, x)[0, 1], rel=1e-9)
    many = next(r for r in rows if r["sample"] == 4.0)
    assert many.theoretical == pytest.approx(t[many.first_rank - 1 : many.last_rank].mean())


# Shapiro and Wilk (1965): weights of 11 men.
MEN = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def shapiro(spark, data):
    df = spark.createDataFrame([("v", float(x)) for x in data], "variable string, value double")
    row = normality.shapiro_wilk(df).first()
    return row.statistic, normality.p_value(row.statistic, row.sample_size)


def test_shapiro_published_example(spark):
    w, p = shapiro(spark, MEN)
    assert w == pytest.approx(0.79, abs=0.005)
    assert p == pytest.approx(0.0067, abs=0.0005)


def test_shapiro_weights():
    for n in (3, 4, 5, 6, 11, 12, 50, 5000):
        a = normality.weights(n)
        assert len(a) == n
        assert sum(x * x for x in a) == pytest.approx(1, abs=1e-9)
        assert sum(a) == pytest.approx(0, abs=1e-9)


def test_shapiro_separates_normal_from_skewed(spark):
    rng = np.random.default_rng(3)
    w, p = shapiro(spark, rng.normal(size=2000))
    assert w > 0.995 and p > 0.01
    w, p = shapiro(spark, rng.lognormal(0, 1.5, 2000))
    assert w < 0.6 and p < 1e-6
    assert shapiro(spark, [5.0] * 20) == (1.0, 1.0)


def test_normality_report(spark):
    rng = np.random.default_rng(4)
    rows = [
        line(invoice=str(i // 3), stockcode=str(i), quantity=int(q), price=float(p))
        for i, (q, p) in enumerate(zip(rng.integers(1, 9, 6000), rng.normal(50, 5, 6000)))
    ]
    table = normality.normality_tests(lines(spark, rows)).collect()
    report = {r.variable: r for r in table}
    assert list(report) == ["Quantity", "Unit Price", "Basket Value"]
    assert {r.sample_size for r in table} == {5000}
    assert report["Quantity"].is_normal == "No"
    assert report["Unit Price"].statistic > 0.99


def test_normality_sample_is_whole_and_reproducible(spark):
    rng = np.random.default_rng(6)
    rows = [
        line(invoice=str(i) if i < 300 else f"e{i}", stockcode=str(i), quantity=int(rng.integers(1, 90)),
             price=float(rng.lognormal()) if i < 300 else None)
        for i in range(9000)
    ]
    df = lines(spark, rows)
    a, b = (
        {r.variable: r for r in normality.normality_tests(df.repartition(n)).collect()} for n in (2, 5)
    )
    assert a == b
    assert {v: r.sample_size for v, r in a.items()} == {"Quantity": 5000, "Unit Price": 300, "Basket Value": 300}


def test_normality_of_copies_is_not_short(spark):
    df = lines(spark, [line(quantity=3)] * 900 + [line(invoice=str(i)) for i in range(100)])
    sample = normality.sample_values(df, limit=50)
    assert {r["count"] for r in sample.groupBy("variable").count().collect()} == {50}


def test_normality_without_values(spark):
    df = lines(spark, [line(price=None), line(price=None)])
    report = {r.variable: r for r in normality.normality_tests(df).collect()}
    assert report["Unit Price"].is_normal == "N/A"
    assert report["Unit Price"].notes == "No valid data"
    assert report["Quantity"].notes == "Insufficient data for test"


def test_basket_metric_and_rollup(spark):
    df = lines(
        spark,
        [
            line(invoice="1", quantity=2, price=10.0, customer_id=None, day=0),
            line(invoice="1", quantity=4, price=20.0, customer_id="7", day=1, stockcode="b"),
            line(invoice="1", quantity=-1, price=30.0, day=2, stockcode="c"),
            line(invoice=None),
            line(invoice="2", quantity=1, price=None),
            line(invoice="3", quantity=1, price=math.inf),
        ],
    )
    metric = {r.invoice: r.basket_value for r in baskets.invoice_basket_metric(df).collect()}
    assert metric == {"1": 100.0, "2": None, "3": math.inf}
    joined = baskets.lines_with_basket(df)
    assert joined.count() == 6
    assert column(joined.where("invoice is null"), "basket_value") == [None]
    rolled = {r.invoice: r for r in baskets.basket_rollup(df).collect()}
    assert (rolled["1"].basket_value, rolled["1"].total_quantity) == (100.0, 6)
    assert rolled["1"].customer_id == "7"
    clean = {r.invoice: r.basket_value for r in baskets.basket_values(df).collect()}
    assert clean == {"1": 100.0, "2": 0.0}


def test_basket_caps(spark):
    data = np.random.default_rng(5).lognormal(3, 1, 2000)
    df = spark.createDataFrame(
        [(str(i), float(v)) for i, v in enumerate(data)], "invoice string, basket_value double"
    )
    impact = {r.percentile: r for r in baskets.cap_impact(df).collect()}
    for p, row in impact.items():
        cap = np.percentile(data, p)
        assert row.threshold == pytest.approx(cap)
        assert row.affected_count == (data > cap).sum()
    assert baskets.recommended_cap(df).first().approach == "Balanced (Recommended)"
    stats = baskets.basket_stats(df).first()
    assert stats.median_value == pytest.approx(np.median(data))
    assert stats.std_value == pytest.approx(data.std(ddof=1))
    top = column(baskets.top_baskets(df).orderBy(F.desc("basket_value")), "basket_value")
    assert top == sorted(data)[::-1][:5]


def test_anomalies(spark):
    df = five(spark)
    table = {r.flag: r.row_count for r in anomalies.anomaly_summary(df).collect()}
    assert table == {
        "extreme_quantity": 1, "extreme_price": 1, "negative_quantity_sale": 0,
        "zero_price_sale": 1, "technical_keyword": 1, "total": 4,
    }
    many = lines(spark, [line(price=20000.0, stockcode=f"{i:03}") for i in range(30)])
    shown = anomalies.anomaly_examples(many).orderBy("example_no")
    assert column(shown, "stockcode") == ["000", "001", "002", "003", "004"]


def test_schema_overview_finds_values_of_sparse_columns(spark):
    rows = [line(stockcode=str(i), day=i % 20, country=None) for i in range(80)]
    rows.append(line(day=20, stockcode="z", country="Malta"))
    table = {r.column_name: r for r in profiling.schema_overview(lines(spark, rows)).collect()}
    assert table["country"].example_values == "Malta"
    assert table["quantity"].example_values == "2, 2, 2"
    assert (table["price"].total_rows, table["price"].total_columns) == (81, 9)


def test_unique_counts_ignore_nulls_and_sign_of_zero(spark):
    df = lines(spark, [line(price=0.0), line(price=-0.0), line(price=None), line(price=1.0)])
    table = {r.column_name: r for r in profiling.unique_counts(df).collect()}
    assert (table["price"].unique_count, table["price"].total_count) == (2, 4)


def test_sanity_and_dates(spark):
    df = five(spark)
    rows = {r.metric: r.row_count for r in profiling.sanity_metrics(df).collect()}
    assert rows == {
        "missing_customer_id": 1, "nonpositive_quantity_sale": 1,
        "nonpositive_price_sale": 1, "credit_note": 1,
    }
    text = df.withColumn("invoicedate", F.col("invoicedate").cast("string")).union(
        df.limit(1).withColumn("invoicedate", F.lit("??"))
    )
    span = profiling.date_coverage(text).first()
    assert tuple(span) == ("2010-06-01", "2010-06-05", 4)
    top = profiling.top_countries(df, 1).first()
    assert tuple(top) == ("United Kingdom", 2, 40.0, 4)


def _valued(spark, n, outliers):
    rng = np.random.default_rng(6)
    rows = [
        (str(i), str(i), int(q), float(p), float(q * p))
        for i, (q, p) in enumerate(zip(rng.integers(1, 20, n), rng.normal(5, 1, n)))
    ]
    rows += [(f"x{i}", "o", 5000 + i, 900.0 + i, 4e6 + i) for i in range(outliers)]
    rows += [("C1", "c", -90000, 1e6, 0.0)]
    return spark.createDataFrame(
        rows, "invoice string, stockcode string, quantity long, price double, basket_value double"
    )


def test_a_tree_splits_neighbouring_and_infinite_values():
    value = 3.3
    for other in (np.nextafter(value, 4.0), -math.inf):
        rows = pd.DataFrame({"tree": 0, "quantity": 1.0, "price": 2.0, "basket_value": [value, other] * 4})
        for seed in range(20):
            tree = forest._grow(rows, seed, 8).iloc[0]
            assert tree["feature"][0] == 2 and min(value, other) <= tree["split"][0] < max(value, other)


def test_forest_removes_injected_outliers_and_keeps_credit(spark):
    df = _valued(spark, 1000, 6)
    config = CleaningConfig(isolation_contam=0.006)
    kept = set(column(forest.remove_outliers(df, config), "invoice"))
    gone = set(column(df, "invoice")) - kept
    assert gone >= {f"x{i}" for i in range(6)}
    assert len(gone) <= 7
    assert "C1" in kept


def test_forest_is_reproducible_and_optional(spark):
    df = _valued(spark, 500, 3)
    config = CleaningConfig(isolation_contam=0.02)
    a = sorted(column(forest.remove_outliers(df, config), "invoice"))
    b = sorted(column(forest.remove_outliers(df.repartition(5), config), "invoice"))
    assert a == b
    assert forest.remove_outliers(df, CleaningConfig(isolation_contam=0.0)).count() == 504
    assert forest.remove_outliers(df.where("invoice = 'C1'"), config).count() == 1


@pytest.mark.parametrize("rows", [40, 2000])
def test_forest_deals_each_tree_its_rows(spark, rows):
    sales = _valued(spark, rows, 4).where("invoice <> 'C1'")
    dealt = forest.deal(sales, 42, trees=10, tree_rows=32)
    sizes = [r["count"] for r in dealt.groupBy("tree").count().collect()]
    assert sizes == [32] * 10
    one, other = (
        {r["h"] for r in dealt.where(F.col("tree") == t).select("h").collect()} for t in (0, 5)
    )
    assert one != other
    again = forest.deal(sales.repartition(7), 42, trees=10, tree_rows=32)
    assert sorted(dealt.collect()) == sorted(again.collect())


def test_forest_parameters(spark):
    df = _valued(spark, 2000, 4)
    config = CleaningConfig(
        isolation_contam=0.002, isolation_trees=20, isolation_tree_rows=64, isolation_depth=6
    )
    assert 3 <= df.count() - forest.remove_outliers(df, config).count() <= 5


def test_psi(spark):
    rng = np.random.default_rng(7)
    rows = [(float(x), True) for x in rng.normal(0, 1, 3000)]
    same = rows + [(x, False) for x, _ in rows]
    moved = rows + [(x + 1, False) for x, _ in rows]

    def index(data):
        df = spark.createDataFrame(data, "x double, base boolean")
        return monitoring.psi(df, "x", F.col("base")).first().psi

    assert index(same) == pytest.approx(0, abs=1e-9)
    assert 0.7 < index(moved) < 1.5


def test_threshold_metrics(spark):
    rng = np.random.default_rng(8)
    score = np.concatenate([rng.integers(0, 101, 400) / 100, [0.29, 0.57, 0.58, 1.0, 0.0]])
    target = rng.integers(0, 2, len(score))
    df = spark.createDataFrame(
        [(float(s), int(t)) for s, t in zip(score, target)], "p double, y int"
    )
    rows = monitoring.threshold_metrics(df, "p", "y").orderBy("threshold").collect()
    assert len(rows) == 101
    for i, row in enumerate(rows):
        flagged = score >= i / 100
        assert row.tp == (flagged & (target == 1)).sum(), i
        assert row.fp == (flagged & (target == 0)).sum(), i
        assert row.tn == (~flagged & (target == 0)).sum(), i
        assert row.flag_rate == pytest.approx(flagged.mean())


def test_full_basket_return_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        credit = rng.random() < 0.4
        rows.append(
            line(
                invoice=("C" if credit else "") + str(rng.integers(0, 120)),
                stockcode=str(rng.integers(0, 4)),
                customer_id=None if rng.random() < 0.05 else str(rng.integers(0, 5)),
                quantity=int(rng.integers(1, 6)) * (-1 if credit else 1),
                day=int(rng.integers(0, 6)) + float(rng.integers(0, 3)) / 4,
            )
        )
    df = lines(spark, rows)
    plain = df.collect()
    want = {}
    for s in plain:
        if s.invoice.startswith("C"):
            continue
        returned = sum(
            -r.quantity
            for r in plain
            if r.invoice.startswith("C")
            and s.customer_id is not None
            and (r.customer_id, r.stockcode) == (s.customer_id, s.stockcode)
            and r.invoicedate >= s.invoicedate
        )
        want[s.invoice] = min(want.get(s.invoice, 1), int(returned >= s.quantity))
    got = {r.invoice: r.full_basket_return for r in monitoring.full_basket_return(df).collect()}
    assert got == want
    assert 0 < sum(want.values()) < len(want)


def test_pseudonymise(spark):
    df = lines(spark, [line(), line(customer_id=None)])
    a, b = monitoring.pseudonymise(df, "salt", "MONTH").collect()
    assert len(a.customer_id) == 64 and b.customer_id is None
    assert a.invoicedate.day == 1
    other = monitoring.pseudonymise(df, "other").first()
    assert other.customer_id != a.customer_id
