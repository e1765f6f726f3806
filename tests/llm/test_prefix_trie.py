from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t[-1] for t in sorted(found)] for c, found in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        out.append(
            (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
             leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def nodes(spark, rows):
    return sorted(map(tuple, prefix_trie.trie_nodes(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def talks(seed, n, longest, words):
    """Few different turns, so that prefixes are shared deeply and copies abound."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            text = "hello there" if t == 0 and rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randrange(3)))
            rows.append((c, t, rng.choice(["user", "user", "bot"]), text))
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    rows = talks(1, 120, 7, ["a", "b"])
    assert nodes(spark, rows) == brute_force(rows)


def test_long_conversations_over_many_parts_and_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "JOINED", 3)
    rng = random.Random(3)
    long = [("user", rng.choice(["x", "y z", ""])) for _ in range(700)]
    rows = [(1000, t, *turn) for t, turn in enumerate(long)]
    # Copies of the long one, cut and branched at many depths: a comb of edges to split.
    for c in range(1001, 1031):
        cut = rng.randrange(1, 700)
        rows += [(c, t, *turn) for t, turn in enumerate(long[:cut])]
        if c % 2:
            rows.append((c, cut, "user", f"turn off {c % 5}"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        assert nodes(spark, rows) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "x"), (0, None, None, None), (0, None, "", ""), (0, 1, "user", "a b\tc"), (0, 1, "user", "a b\tc"),
        (1, 2, "a", "1:b"), (2, 2, "a1:", "b"), (21, 1, "u", "only"), (41, 5, "u", "base is absent"), (-7, 1, "u", "below zero"),
        (-20, 3, "u", "base below zero"), (61, 1, "u", "w " * 50_000), (62, 1, "u", "\x0b\x0c"), (63, 1, "ü", "日本 語"),
    ]
    assert nodes(spark, rows) == brute_force(rows)
    assert nodes(spark, rows[:1]) == [] and nodes(spark, []) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    # One turn each, no base: those that skip one turn or more have none left.
    rows = [(c, 0, "u", "hi") for c in range(101, 119)]
    found = nodes(spark, rows)
    assert found == brute_force(rows)
    assert {r[1] for r in found} == {0, 1}


def test_other_columns_may_clash(spark):
    rows = talks(2, 30, 5, ["a"])
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("part", "symbol", "words", "position", "hash", "key", "name", "depth", "base", "h", "n", "edge"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert sorted(map(tuple, prefix_trie.trie_nodes(frame).collect()), key=str) == brute_force(rows)


def test_two_fattest(spark):
    rows = [(a, b) for a in range(0, 40) for b in range(a + 1, 70)]
    got = spark.createDataFrame(rows, "a long, b long").select(
        "a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b"))
    ).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 500])
def test_running_hashes_equal_horner(n):
    rng = np.random.default_rng(n)
    symbols = rng.integers(0, 2**32, (n, prefix_trie.LANES))
    begins = np.unique(np.r_[0, rng.integers(0, n, 5)])
    starts = begins[np.searchsorted(begins, np.arange(n), side="right") - 1]
    got = prefix_trie.running(symbols, starts)
    for lane in range(prefix_trie.LANES):
        m, b, h = int(prefix_trie.MODULI[lane]), int(prefix_trie.BASES[lane]), 0
        for i in range(n):
            h = ((h if i not in begins else 0) * b + int(symbols[i, lane])) % m
            assert got[i, lane] == h
