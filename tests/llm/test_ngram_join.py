from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from ledgerlint.llm import graph, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, num, den):
    sets, up = [grams(t, n) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", "  \n", "one", "One", "one two", "one two\x0b", "two one", "x\x85y z", "é É a b c"]
    for size in (3, 4, 6, 11, 12, 20, 21, 40, 90, 400):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, size // 12):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                texts.append(" ".join(copy[: len(copy) - rng.choice([0, 0, 0, 1, 2])]).upper())
    chain = [rng.choice(vocabulary) for _ in range(150)]
    for step in range(25):  # neighbours are similar, the ends are not
        chain[step * 6 % 150] = f"new{step}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (1, 50, 100), (2, 100, 100)])
def test_equals_brute_force(spark, n, num, den):
    rows = corpus(n)
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, node string, key int")
    got = ngram_join.link_documents(docs.repartition(4), n, num, den).collect()
    assert sorted(map(tuple, got)) == brute(rows, n, num, den)


def test_every_similar_pair_shares_a_key():
    rng = np.random.default_rng(3)
    bands = ngram_join.Bands(80, 100)
    for size in list(range(2, 40)) + [100, 500]:
        plan = bands.of(size * 2)
        for _ in range(20):
            whole = rng.integers(0, 1 << 63, size=size * 2, dtype=np.uint64)
            a = np.sort(whole[:size])
            gone, new = int(rng.integers(0, size)), int(rng.integers(0, size))
            b = np.sort(np.concatenate([a[: size - gone], whole[size : size + new]]))
            common = len(np.intersect1d(a, b))
            if not len(b) or 100 * common < 80 * (len(a) + len(b) - common) or (len(a) == len(b) == common):
                continue
            keys, names = ngram_join.sketch_keys(
                np.concatenate([a, b]), np.array([len(a), len(b)]), np.array([1, 2], dtype=np.int64), plan
            )
            assert set(keys[names == 1]) & set(keys[names == 2])


@pytest.mark.parametrize("held", [1, 1 << 19])
def test_words_with_company_are_found_in_any_batches(monkeypatch, held):
    monkeypatch.setattr(ngram_join, "HELD_WORDS", held)
    rng = np.random.default_rng(held)
    pool = rng.integers(-(1 << 63), 1 << 63, 4000)
    key, node = rng.choice(pool, 6000), rng.integers(-(1 << 63), 1 << 63, 300)[rng.integers(0, 300, 6000)]
    key[:900] = pool[0]  # a common word
    key, node = np.r_[key, key[:500]], np.r_[node, node[:500]]  # and repeated rows
    parts = [ngram_join._packed_words(k, n) for k, n in zip(np.array_split(key, 5), np.array_split(node, 5))]
    parts.append(ngram_join._packed_words(key[:0], node[:0]))
    packed = pa.Table.from_batches(parts).sort_by("bucket")
    assert packed.nbytes / len(key) < 40  # small batches; 14 bytes and the share of a bucket's row
    found = set()
    for batch in ngram_join._company(iter(packed.to_batches(max_chunksize=700))):
        found |= set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    nodes = {}
    for k, n in zip((key.view(np.uint64) >> np.uint64(4)).tolist(), node.tolist()):
        nodes.setdefault(k, set()).add(n)
    assert found == {(k, n) for k, of in nodes.items() if len(of) > 1 for n in of}
    assert list(b.num_rows for b in ngram_join._company(iter([]))) == [0]


def test_a_word_takes_fourteen_bytes():
    rng = np.random.default_rng(1)
    key, node = rng.integers(-(1 << 63), 1 << 63, (2, 500_000))
    batch = ngram_join._packed_words(key, node)
    assert batch.nbytes < 14.5 * len(key)


def test_no_shuffle_files_stay_of_what_is_stored(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = []
        while found.hasNext():
            names.append(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    docs = spark.createDataFrame(corpus(2), "doc_id long, text string").repartition(4)
    before = files()
    placed = ngram_join.join(docs)
    for _ in range(50):  # removal is asynchronous
        if len(files() - before) < 60:
            break
        time.sleep(0.2)
    assert len(files() - before) < 60  # those of counts, a row each
    assert placed.count() == len(corpus(2))


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text + " tail"), (4, "other words of a text"), (4, "other words of a text"), (7, None), (8, ""), (8, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 7, 8, 8]


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_components_equal_a_search(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(few)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(9, 9), (500, 501), (501, 500)]
    least = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(400):
        for u, v in edges:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    got = graph.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == least
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_keeps_columns_of_any_name_and_rows_without_words(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "a", "b"), (1, text, "a", "b"), (2, text + " end", "c", "d"), (3, "", "e", "f"), (3, "", "e", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, `a.b` string")
    docs = docs.selectExpr("*", "'n' AS n", "'r' AS row", "'x' AS doc", "true AS wordless", "'k' AS __n")
    got = ngram_join.keep_one(docs).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        (d, t, x, y, "n", "r", "x", True, "k") for d, t, x, y in (rows[0], rows[3], rows[4])
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_documents(docs).collect() == []
    assert ngram_join.keep_one(docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (101, 100)]
    out = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    got = {r["node"]: r["component"] for r in out}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}} and len(out) == len(got)
