from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlint.operators import quantiles as q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 0.995, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@pytest.mark.parametrize("parts", [None, 20])
@pytest.mark.parametrize("kind", ["uniform", "skewed", "ties", "constant", "negative"])
def test_matches_numpy(spark, kind, parts):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.uniform(0, 1, 5000),
        "skewed": rng.lognormal(0, 4, 5000),
        "ties": np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 30, 5000)),
        "constant": np.full(500, 3.5),
        "negative": -rng.lognormal(0, 2, 3000),
    }[kind]
    got = q.exact_quantiles(frame(spark, values), "x", PROBS, parts=parts)
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_a_frequent_value_and_more_parts_than_values(spark):
    values = np.r_[np.full(3000, 2.0), np.random.default_rng(2).normal(size=1500), [-0.0, 0.0, 1e300, -1e300]]
    got = q.exact_quantiles(frame(spark, values), "x", PROBS, parts=300)
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_several_columns_share_the_passes(spark):
    a, b = np.random.default_rng(4).normal(size=500), np.arange(90.0)
    columns = {"a": (frame(spark, a), "x"), "b": (frame(spark, b), "x"), "none": (frame(spark, []), "x")}
    got = q.column_quantiles(columns, {"a": [0.1, 0.9], "b": [0.5], "none": [0.5, 1.0]}, parts=7)
    assert got["a"] == pytest.approx(list(np.quantile(a, [0.1, 0.9])))
    assert (got["b"], got["none"]) == ([44.5], [None, None])


def test_no_task_ranks_more_than_a_range(spark):
    stored = q.ranged(
        frame(spark, range(4000)).selectExpr("'v' AS variable", "x AS value", "1L AS weight"), 16
    )
    sizes = [r["count"] for r in stored.groupBy("part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1000
    ranks = q.value_ranks(stored.select("variable", "value", "weight"), 16).collect()
    assert all(r.first_rank == r.last_rank == r.value + 1 for r in ranks)


@pytest.mark.parametrize("parts", [None, 10])
def test_weights_repeat_values(spark, parts):
    rng = np.random.default_rng(3)
    values, counts = rng.normal(size=400), rng.integers(1, 50, 400)
    counts[7] = 5000
    df = spark.createDataFrame(
        [(float(v), int(n)) for v, n in zip(values, counts)], "x double, n long"
    )
    got = q.exact_quantiles(df, "x", PROBS, weight="n", parts=parts)
    assert got == pytest.approx(list(np.quantile(np.repeat(values, counts), PROBS)), rel=1e-12)


def test_empty_and_unusable_values(spark):
    assert q.exact_quantiles(frame(spark, []), "x", [0.5]) == [None]
    df = frame(spark, [1.0, float("nan"), float("inf"), 3.0])
    assert q.exact_quantiles(df, "x", [0.5]) == [2.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.floats(0, 1))
def test_any_list(spark, values, p):
    (got,) = q.exact_quantiles(frame(spark, values), "x", [p], parts=4)
    assert got == pytest.approx(float(np.quantile(values, p)), abs=1e-9)
