from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import line_dedup, oracle, queries
from tests.compare import connect, difference

SPACE = " \t\n\x0b\x0c\r"


def brute(texts, min_docs, min_chars):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    keys = [[x.strip(SPACE).translate(lower) for x in (t or "").split("\n")] for t in texts]
    counts = {}
    for one in keys:
        for k in {k for k in one if len(k) >= min_chars}:
            counts[k] = counts.get(k, 0) + 1
    out = []
    for t, one in zip(texts, keys):
        kept = [x for x, k in zip((t or "").split("\n"), one) if counts.get(k, 0) < min_docs]
        out.append((len(one), len(one) - len(kept), "\n".join(kept)))
    return out


TEXTS = (
    [None, "", "\n\n", "  \n a", "A\nb\nÄ", "a \nB", "\x0ba\x0c\nb", "ä\nx", " a", "b\n" * 500 + "tail"]
    + ["same\nsame\nown %d" % (i % 3) for i in range(7)]
    + ["z" * 30000 + "\nb"]
)


@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 1), (5, 1), (2, 2)])
def test_equals_brute_force(spark, min_docs, min_chars):
    rows = [(i // 2, t, "x", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n int").repartition(5)
    out = line_dedup.drop_shared_lines(docs, min_docs, min_chars).orderBy("n").collect()
    want = brute(TEXTS, min_docs, min_chars)
    assert [(r["n_lines"], r["n_dropped"], r["kept"]) for r in out] == want
    assert [r["key"] for r in out] == ["x"] * len(rows)


def test_full_filters_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_BITS", 64)
    test_equals_brute_force(spark, 3, 1)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a\nb"), (None, "a\nb"), (None, "a"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.drop_shared_lines(docs, 3).select("kept", "n_dropped").collect()
    assert sorted(map(tuple, out)) == [("", 0), ("", 1), ("b", 1), ("b", 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_shared_lines(docs).collect() == []


def test_filters_know_what_two_tasks_met(spark):
    values = spark.range(0, 2000, 1, 8).select((F.col("id") % 1500).cast("string").alias("t"))
    once, twice = line_dedup.filters(values, 1 << 16)
    hashes = line_dedup.hash_keys([str(i).encode() for i in range(1500)])
    assert line_dedup.holds(once, hashes).all()
    suspected = line_dedup.holds(twice, hashes)
    assert suspected[:500].all() and suspected.sum() < 600


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    sql = oracle.ORACLE_SQL["op5_line_dedup"]
    assert difference(spark, connect(sf), sf, queries.QUERIES["op5_line_dedup"], sql) is None
