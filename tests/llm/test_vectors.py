from __future__ import annotations

import numpy as np
import pytest

from ledgerlint.llm import hnsw, neighbour_graph
from ledgerlint.llm.oracle import ORACLE_SQL
from ledgerlint.llm.queries import QUERIES
from tests.compare import connect, difference

SCHEMA = "vec_id long, embedding array<double>, label int, node int, grp string"


def rows(seed=0, n=900, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    for at, size in ((0, 150), (200, 20), (300, 2), (400, 3)):
        if at + size <= n:
            base[at : at + size] = base[at] + 0.12 * rng.normal(size=(size, dim)) * np.linalg.norm(base[at]) / dim**0.5
    out = [(int(i), [float(v) for v in x * (1 + i % 5)], int(i % 2) if i >= 450 else 0, 1, "x") for i, x in enumerate(base)]
    out += [
        (2000, None, 1, 1, "x"), (2001, [0.0] * dim, 1, 1, "x"), (2002, [float("nan")] * dim, 1, 1, "x"),
        (2003, [1.0, None] + [0.0] * (dim - 2), 1, 1, "x"), (2004, [float("inf")] + [1.0] * (dim - 1), 1, 1, "x"),
        (2005, out[0][1], None, 1, "x"), (2006, out[0][1], 0, 1, "x"), (2006, out[0][1], 0, 1, "x"),
        (2020, [1.0, 2.0], 0, 1, "x"), (2040, [2.0, 4.0], 0, 1, "x"), (2007, [], 0, 1, "x"),
    ]
    return out


def fit(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_near_vectors_equal_brute_force(spark):
    data = rows()
    out = neighbour_graph.link_vectors(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    links, up = [0] * len(data), list(range(len(data)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(data):
        for j in range(i):
            b = data[j]
            if a[2] is None or a[2] != b[2] or not fit(a[1]) or not fit(b[1]) or len(a[1]) != len(b[1]):
                continue
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(data):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    want = sorted((r[0], links[i], least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(data))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out) == want


def test_large_components_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 16)
    test_near_vectors_equal_brute_force(spark)


def test_near_vectors_equal_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(spark, connect(sf), sf, QUERIES["op7_near_vectors"], ORACLE_SQL["op7_near_vectors"]) is None


def exact(data, step, k):
    use = [r for r in data if fit(r[1]) and r[0] is not None]
    out = {}
    for q in use:
        if q[0] % step:
            continue
        scored = sorted((-float(np.dot(q[1], r[1])), r[0]) for r in use if r[0] != q[0] and len(r[1]) == len(q[1]))
        out[q[0]] = scored[:k]
    return out


@pytest.mark.parametrize("shard,least", [(100, 0.999), (8192, 0.97)])
def test_recall_and_scores(spark, monkeypatch, shard, least):
    monkeypatch.setattr(hnsw, "SHARD", shard)
    monkeypatch.setattr(hnsw, "QUERIES", 20)
    data = rows(1, 1500)
    got = {}
    for r in hnsw.nearest(spark.createDataFrame(data, SCHEMA).repartition(3), step=20, k=20).collect():
        got.setdefault(r["query_id"], []).append(r)
    want = exact(data, 20, 20)
    assert set(got) == {q for q, x in want.items() if x}
    hits = total = 0
    vectors = {r[0]: r[1] for r in data}
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        for r in found:
            assert r["score"] == pytest.approx(float(np.dot(vectors[q], vectors[r["vec_id"]])), rel=1e-12)
        hits += len({r["vec_id"] for r in found} & {i for _, i in want[q]})
        total += len({i for _, i in want[q]})
    assert hits / total >= least


def test_few_vectors_and_empty_tables(spark):
    few = spark.createDataFrame(rows(2, 12)[:12], SCHEMA)
    out = hnsw.nearest(few, step=5, k=20).collect()
    assert {q: sum(r["query_id"] == q for r in out) for q in (0, 5, 10)} == {0: 11, 5: 11, 10: 11}
    none = few.where("vec_id < 0")
    assert hnsw.nearest(none).collect() == []
    assert neighbour_graph.link_vectors(none).collect() == []


def brute_components(data, threshold=0.98):
    """(vec_id, n_links, component_id) by all pairs of one label."""
    x = np.array([r[1] for r in data])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in data])
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    low = np.array([r[0] for r in data])
    while True:
        new = np.minimum(low, np.where(near, low[None, :], low.max()).min(axis=1))
        if (new == low).all():
            return sorted((r[0], int(n), int(c)) for r, n, c in zip(data, near.sum(axis=1), low))
        low = new


def beside(rng, v, cosine):
    w = rng.normal(size=len(v))
    w -= w @ v * v
    return cosine * v + (1 - cosine**2) ** 0.5 * w / np.linalg.norm(w)


def test_groups_of_copies_that_touch_are_one_component(spark):
    """Lists full of copies or near copies do not hide the links between groups."""
    rng = np.random.default_rng(4)
    data = []
    for noise in (0.0, 0.0, 1e-4, 1e-4, 1e-4):
        a = rng.normal(size=24)
        a /= np.linalg.norm(a)
        for v in (a, beside(rng, a, 0.985)):
            data += [v + noise * rng.normal(size=24) for _ in range(60)]
    data += list(rng.normal(size=(300, 24)))
    data = [(i, [float(c) for c in v], 1, 1, "x") for i, v in enumerate(data)]
    out = neighbour_graph.link_vectors(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out)
    assert got == brute_components(data)
    assert {n for _, n, _ in got} == {0, 119}


def test_links_outside_a_large_group_are_audited(spark, monkeypatch):
    """A group of a third of the rows does not hide that all other links are missed."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=24)
    a /= np.linalg.norm(a)
    data = [a + 1e-3 * rng.normal(size=24) for _ in range(120)]
    for _ in range(30):
        v = rng.normal(size=24)
        v /= np.linalg.norm(v)
        data += [v, beside(rng, v, 0.985)]
    data += list(rng.normal(size=(180, 24)))
    data = [(i, [float(c) for c in v], 1, 1, "x") for i, v in enumerate(data)]

    def only_the_group(batches):
        for rows in batches:
            yield rows[(rows["u"] < 120) & (rows["v"] < 120)]

    frame = spark.createDataFrame(data, SCHEMA).coalesce(1)
    seeded, refined = neighbour_graph._seeded, neighbour_graph._refined
    cut = lambda edges: edges.mapInPandas(only_the_group, edges.schema)
    monkeypatch.setattr(neighbour_graph, "_seeded", lambda *a: cut(seeded(*a)))
    monkeypatch.setattr(neighbour_graph, "_refined", lambda *a: cut(refined(*a)))
    monkeypatch.setattr(neighbour_graph, "MORE_CODES", 1)
    out = neighbour_graph.link_vectors(frame).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == brute_components(data)


def test_longer_codes_are_more():
    counts = [neighbour_graph._codes(bits, 0.98) for bits in (1, 10, 14, 24, 40)]
    assert counts == sorted(counts) and counts[0] == neighbour_graph.CODES < counts[-1]
    assert 1 - (1 - (1 - np.arccos(0.98) / np.pi) ** 24) ** counts[3] >= 1 - neighbour_graph.APART


def test_large_groups_of_equal_vectors_give_their_smallest_ids(spark):
    """Groups of copies beyond the beam give the ids that brute force gives."""
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=24), rng.normal(size=24)
    vectors = [a] * 450 + [b] * 300 + list(rng.normal(size=(450, 24)))
    ids = rng.permutation(len(vectors))
    data = [(int(i), [float(c) for c in v], 1, 1, "x") for i, v in zip(ids, vectors)]
    got = {}
    for r in hnsw.nearest(spark.createDataFrame(data, SCHEMA).repartition(3), step=20, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = {q: {i for _, i in x} for q, x in exact(data, 20, 20).items()}
    copied = [q for q in want if np.flatnonzero(ids == q)[0] < 750]
    assert copied and all(got[q] == want[q] for q in copied)
    assert sum(len(got[q] & want[q]) for q in want) >= 0.99 * sum(map(len, want.values()))
