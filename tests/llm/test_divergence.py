from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlint.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, min_docs, top):
    docs = [
        (lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for _, text, lang, source, _ in rows
    ]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in here for t in d[2])
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        groups = sorted({d[1] for d in here})

        def shares(chosen):
            count = Counter()
            for d in chosen:
                count.update({t: n for t, n in d[2].items() if seen[t] >= min_docs})
            size = sum(count.values()) + 2 * len(kept)
            return count, {t: 1 + 10**9 * (count[t] + 2) // size for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        _, whole = shares(here)
        of = {g: shares([d for d in here if d[1] == g]) for g in groups}
        for g in groups:
            pairs = [(-sum(f(of[g][1][t], of[h][1][t]) for t in kept), h.encode()) for h in groups if h != g]
            out += [(lang, g, "pair", h.decode(), -v, r + 1) for r, (v, h) in enumerate(sorted(pairs))]
            count, p = of[g]
            terms = [(-f(p[t], whole[t]), t.encode()) for t in kept if count[t] > 0 and p[t] > whole[t]]
            out += [(lang, g, "term", t.decode(), -v, r + 1) for r, (v, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def audit(spark, rows, min_docs=3, top=4):
    return sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs, top).collect()))


def corpus(seed, groups, docs, words):
    rng = random.Random(seed)
    names = ["Élan", "straße", "don't", "x2y", "ÀB", "日本", "a_b"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)]
    rows = []
    for i in range(docs):
        source = "hot" if rng.random() < 0.3 else f"s{rng.randrange(groups)}"
        near = names[: rng.randrange(5, len(names))]
        rows.append((i, " ".join(rng.choices(near, k=rng.randrange(0, 30))), rng.choice(["en", "de"]), source, 0))
    return rows


@pytest.mark.parametrize("few", [0, 50_000])
def test_equals_brute_force_over_many_tiles(spark, monkeypatch, few):
    monkeypatch.setattr(divergence, "SIDE", 4)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "LONG", 40)
    monkeypatch.setattr(divergence, "FEW", few)
    rows = corpus(1, 14, 300, 60)
    assert audit(spark, rows) == brute_force(rows, 3, 4)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", "", 0), (None, "a A a", "en", None, 1), (3, "a\x00b 1 a", "en", "s", 1),
        (3, "a\x00b 1 a", "en", "s", 1), (4, "B a 'a", "en", "t", 1), (5, "12 !?", "en", "none", 1), (6, "x", "fr", "alone", 1),
        (7, "y " * 100_000, "en", "t", 1), (8, "y a", "en", "é", 1), (9, "y", "en", "z", 1), (10, "q", "de", "a", 1),
        (11, "q", "de", "b", 1),
    ]
    found = audit(spark, rows)
    assert found == brute_force(rows, 3, 4)
    assert ("de", "a", "pair", "b", 0, 1) in found and not [r for r in found if r[0] == "fr"]
    assert audit(spark, []) == []


def test_other_columns_may_clash(spark):
    rows = corpus(2, 3, 60, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "n", "docs", "tile", "block", "row", "size", "part", "item", "value", "rank"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert sorted(map(tuple, divergence.audit(frame, 3, 4).collect())) == brute_force(rows, 3, 4)


def test_walk_finds_the_leaves_of_both_trees():
    rng = np.random.default_rng(4)
    n = divergence.SIDE

    def matrix(share):
        return np.where(rng.random((n, n)) < share, rng.integers(1, 9, (n, n)), 0)

    for x, y in [(matrix(0.01), matrix(0.3)), (matrix(0.002), matrix(0.002))]:
        def tree(m):
            rows, columns = np.nonzero(m)
            packed = divergence.Quadtree.build(rows, columns, m[rows, columns]).packed()
            return divergence.Quadtree.unpacked(*packed)

        a, b = tree(x), tree(y)
        ra, la, rb, lb = divergence.walk(a, b)
        got = sorted(zip(ra.tolist(), rb.tolist(), a.counts[la].tolist(), b.counts[lb].tolist()))
        want = sorted(
            (g, h, x[g, c], y[h, c]) for c in range(n) for g in np.flatnonzero(x[:, c]) for h in np.flatnonzero(y[:, c])
        )
        assert got == want


def test_shares_are_exact_beyond_doubles():
    counts = np.array([0, 7, 3 * 10**14, 4 * 10**15 + 1])
    size = np.full(4, 4 * 10**15 + 11)
    want = [1 + 10**9 * (int(c) + 2) // int(s) for c, s in zip(counts, size)]
    assert divergence.shares(counts, size).tolist() == want
