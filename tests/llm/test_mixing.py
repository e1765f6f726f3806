from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerlint.llm import mixing


def water_fill(sizes, weights, total, most):
    """Brute force: targets by weight, the excess of the full ones reshared until none is above."""
    targets, open_ones, left = [most * s for s in sizes], list(range(len(sizes))), float(total)
    while open_ones:
        unit = left / sum(weights[i] for i in open_ones)
        full = [i for i in open_ones if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_ones:
                targets[i] = unit * weights[i]
            break
        left = max(left - sum(most * sizes[i] for i in full), 0.0)
        open_ones = [i for i in open_ones if i not in full]
    return targets


@pytest.mark.parametrize("sizes", [[100, 100, 100], [100, 190, 10], [], [0, 5], [0, 0], [1, 2, 3, 4, 5000, 6, 7, 900] * 9])
@pytest.mark.parametrize("share", [1.0, 0.4, 4.0])
def test_targets_share_the_excess(spark, sizes, share):
    names = [f"s{i:03}" for i in range(max(len(sizes) - 1, 0))] + [None]  # null last
    rows = [(n, s, 1) for n, s in zip(names, sizes)]
    sized = spark.createDataFrame(rows, "source string, size long, n long").repartition(5)
    got = {r["source"]: r["target"] for r in mixing.source_plan(sized, (1, 2, 3), share, 3.0).collect()}
    weights = [float(i % 3 + 1) for i in range(len(sizes))]
    want = water_fill(sizes, weights, share * sum(sizes), 3.0)
    assert [got[n] for n, _, _ in rows] == pytest.approx(want)


def test_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 256)
    monkeypatch.setattr(mixing, "MANY", 50)
    largest = spark.sparkContext.accumulator(0)
    pivot = mixing.pivot

    def counted(sizes, mass, rng):
        assert len(sizes) < 1200  # of 20,000 equal rows
        largest.add(len(sizes))
        return pivot(sizes, mass, rng)

    monkeypatch.setattr(mixing, "pivot", counted)
    rows = [(1, "a b c", "s")] * 20000 + [(i, "w " * (i % 9), "s" if i % 2 else "t") for i in range(2, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    out = [tuple(r) for r in mixing.taken(docs).collect()]
    assert len(out) == len(rows) and largest.value > 20000
    assert sorted(out) == sorted(tuple(r) for r in mixing.taken(docs.repartition(3)).collect())
    size, target = next((r[2], r[3]) for r in out if r[0] == 1)
    assert size == 60000 + sum(i % 9 for i in range(2, 2000) if i % 2)
    assert abs(sum(r[4] for r in out if r[2] == size) - target) <= 8
    want = sum(r[4] // r[1] for r in out if r[0] == 1)
    assert mixing.mix(docs).where("doc_id = 1").count() == want


def test_pivot_keeps_the_sum_and_leaves_one():
    sizes = np.array([float(1 + i % 17) for i in range(500)])
    out = mixing.pivot(sizes, sizes * 0.37, random.Random(5))
    assert out.sum() == pytest.approx((sizes * 0.37).sum())
    assert ((out > 0) & (out < sizes)).sum() <= 1


def test_pivot_is_unbiased():
    sizes, mean = np.array([3.0, 5.0, 2.0, 8.0]), np.zeros(4)
    for seed in range(4000):
        mean += mixing.pivot(sizes, sizes * 0.3, random.Random(seed))
    assert mean / 4000 == pytest.approx(sizes * 0.3, abs=0.25)


def frame(spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 3}" if i % 10 else None, "clash") for i in range(3000)]
    rows += [(None, None, "s0", "x"), (5000, "", "s1", "x"), (5001, "a b", "empty", "x"), (5001, "a b", "empty", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


@pytest.mark.parametrize("chunk", [16, 4096])
def test_targets_and_reruns(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    docs = frame(spark)
    out = [r.asDict() for r in mixing.taken(docs.repartition(3)).collect()]
    again = [r.asDict() for r in mixing.taken(docs.repartition(7)).collect()]
    key = lambda r: (str(r["doc_id"]), r["taken"])
    assert sorted(out, key=key) == sorted(again, key=key)
    assert len(out) == docs.count()
    total = {}
    for r in out:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        assert r["target"] <= 3 * r["source_size"] + 1e-6
        got = total.setdefault(r["target"], [0, 0])
        got[0] += r["taken"]
        got[1] = max(got[1], r["size"])
    for target, (words, largest) in total.items():
        assert abs(words - target) <= largest
    assert sum(total) == pytest.approx(sum(r["size"] for r in out))


def test_mix_repeats_rows(spark):
    docs = frame(spark)
    counts = {}
    for r in mixing.mix(docs).collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    want = {}
    for r in mixing.taken(docs).where("size > 0 AND copies > 0").collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    assert counts == want
    assert mixing.mix(docs).columns == docs.columns


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(i, "w " * (i % 9 + 1), f"s{i % 3}", f"x{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __row string")
    docs = docs.selectExpr("*", "'n' AS n", "'r' AS row", "7 AS copies", "'y' AS __copies", "'z' AS doc")
    got = mixing.mix(docs).collect()
    assert got and {tuple(r) for r in got} <= {(*r, "n", "r", 7, "y", "z") for r in rows}


def test_empty_table(spark):
    docs = frame(spark).where("doc_id = -1")
    assert mixing.taken(docs).collect() == []
    assert mixing.mix(docs).collect() == []
