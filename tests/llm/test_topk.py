from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerlint.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, step, k):
    fit = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(fit):
        if i % step:
            continue
        scored = [
            (-sum(s * t for s, t in zip(q, v)), j)
            for b, (j, v) in enumerate(fit)
            if a != b and len(v) == len(q)
        ]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, step=10, k=5):
    return sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, SCHEMA), step, k).collect()))


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(n, dim)).astype(np.float32))]


@pytest.mark.parametrize("dim", [1, 7])
def test_equals_brute_force_over_many_shards(spark, monkeypatch, dim):
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "HELD", 256)
    rows = vectors(500, dim, dim)
    assert found(spark, rows) == brute_force(rows, 10, 5)


def test_groups_of_copies_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 32)
    rng = random.Random(5)
    kinds = [[float(rng.randint(-2, 2)) / 8 for _ in range(6)] for _ in range(12)]
    rows = [(i, kinds[0] if i % 3 == 0 else rng.choice(kinds), 0) for i in range(300)]
    rows += [rows[0], rows[0], rows[20], (20, kinds[3], 1)]  # repeated rows, and an id with two vectors
    rng.shuffle(rows)
    assert found(spark, rows) == brute_force(rows, 10, 5)


def test_nearly_equal_vectors(spark, monkeypatch):
    """All near copies pass the uniform threshold; the result is whole."""
    monkeypatch.setattr(topk, "SHARD", 100)
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in base + rng.normal(size=16) / 300], 0) for i in range(400)]
    assert found(spark, rows) == brute_force(rows, 10, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (10, None, 0), (20, [1.0, None], 0), (30, [nan, 1.0], 0), (40, [inf, 1.0], 0),
        (None, [1.0, 1.0], 0), (50, [0.0, -0.0], 0), (60, [-0.0, 0.0], 0), (70, [], 0), (80, [], 0),
        (1, [-1.0, 0.5], None), (2, [0.0004, -0.0004], 1), (90, [1.0, 2.0, 3.0], 0),
    ]
    assert found(spark, rows) == brute_force(rows, 10, 5)
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, 1e5], 0), (1, [3e5, -5.0], 0), (2, [-2e5, 7e5], 0), (10, [float(np.float32(123456.789)), 9e5], 0)]
    assert found(spark, rows) == brute_force(rows, 10, 5)
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [1e20], 0), (1, [1e20], 0)])


def test_other_columns_may_clash(spark):
    rows = vectors(60, 4, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "key", "row", "n", "part", "dim", "query", "score", "rank", "vector", "copy"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert sorted(map(tuple, topk.top_k(frame, 10, 5).collect())) == brute_force(rows, 10, 5)


def test_phases_agree_with_all_scores():
    rng = np.random.default_rng(2)
    rows = np.floor(1024 * rng.normal(size=(200, 9)))
    queries = rows[:10]
    scores = (queries @ rows.T).astype(np.int64)
    kth = -np.sort(-scores, axis=1)[:, 4]
    heads = topk.gather(queries, rows, 5)
    assert (heads[:, 4] <= kth).all() and (heads[:, 0] == scores.max(axis=1)).all()
    q, row, s = topk.collect(queries, rows, heads[:, 4])
    want = {(a, b) for a, b in zip(*np.nonzero(scores >= heads[:, 4][:, None]))}
    assert set(zip(q.tolist(), row.tolist())) == want
    assert (s == scores[q, row]).all()
