"""Near-duplicate vectors by NN-descent.

A neighbour graph is seeded from sorted neighbourhoods: under several random
hyperplane codes, each vector meets the vectors next to it in the order of code
and projection. Rounds then refine it: at every node, its neighbours and the
nodes that have it as a neighbour are compared with each other, and each keeps
the nearest it has met. The recall of the threshold edges is audited against
brute force for a bounded sample, as the mean over its vectors; while it is short,
more codes are added, and if it stays short, all vectors of a label are compared
in blocks. The longer the codes, the more of them are used; those of a small label
are short.

Equal vectors are one node with a multiplicity. Neighbour lists hold ``K``
entries, but an edge at or above the threshold that is met anywhere is kept apart
from them, as a tie: of the edges met in one batch, ties that join the same nodes.
Where a list is full of edges above the threshold, the nodes tied so far no longer
take its places: each node then keeps ``K`` neighbours of its own component and
``K`` of others, meets vectors behind its component in the order of further codes,
and this goes on until no list of others is full of such edges. In the end each
component is compared whole, in blocks, and every link in it is counted. Only
counts leave a block, so a large group of copies does not become pairs.

Only vectors of the same label and length are compared.

Cases: null, zero and non-finite vectors and vectors without label link with
nothing and are returned; repeated rows are rows of their own (equal vectors
link; their vec_id counts as smallest as usual); a null vec_id is returned with
no links unless its vector links; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.graph import components
from ledgerlint.operators.joins import attach_group_values
from ledgerlint.llm.vectors import doubles, matrix, unit, usable
from ledgerlint.sources.staging import stage

K = 12
#: Hyperplane codes at first, the bits of each, and the neighbours met in order.
CODES = 10
BITS = 10
MET = 16
ROUNDS = 2
#: Vectors of the audit, the recall it asks for, and the codes added at most.
AUDITED = 400
RECALL = 0.995
MORE_CODES = 3
#: Share of links at the threshold that may agree on no whole code, and codes at most.
APART = 1e-3
MOST_CODES = 100
#: Vectors of a block of a component.
BLOCK = 1024

#: kind: a neighbour of another component, of the own one, or a tie.
_EDGES = "u long, v long, s double, kind int"
_OTHER, _OWN, _TIE = 0, 1, 2


def _coded(first: int, codes: int, bits: int, seed: int):
    """(code number, code, place, node, group, vector) of each vector under each code."""

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, part in rows.groupby(rows["vector"].map(len)):
                x = unit(matrix(part["vector"]))
                for c in range(first, first + codes):
                    rng = np.random.default_rng([seed, c, x.shape[1]])
                    planes = rng.normal(size=(x.shape[1], bits + 1))
                    side = x @ planes
                    code = (side[:, :bits] > 0) @ (1 << np.arange(bits))
                    code &= (1 << part["bits"].to_numpy()) - 1
                    yield pd.DataFrame(
                        {"c": c, "code": code, "place": side[:, bits], "node": part["node"].to_numpy(),
                         "grp": part["grp"].to_numpy(), "component": part["component"].to_numpy(), "vector": list(x)}
                    )

    return coded


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs and the smallest node each is joined with, if not itself."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(names))
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], least)
        np.minimum.at(new, low[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == low).all():
            break
        low = new
    moved = low != np.arange(len(names))
    return names[moved], names[low[moved]]


def _ties(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    node, least = _stars(u, v)
    return pd.DataFrame({"u": node, "v": least, "s": np.ones(len(node)), "kind": np.full(len(node), _TIE, np.int32)})


def _meet(threshold: float):
    """Edges between vectors that follow each other closely in a sorted code."""

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for rows in batches:
            rows = rows if tail is None else pd.concat([tail, rows], ignore_index=True)
            fresh = 0 if tail is None else len(tail)
            tail = rows.iloc[-MET:]
            key = rows[["grp", "c", "code"]].to_numpy()
            lengths = rows["vector"].map(len).to_numpy()
            width = lengths.max(initial=0)
            x = np.zeros((len(rows), width))
            for i, v in enumerate(rows["vector"]):
                x[i, : len(v)] = v
            node, component = rows["node"].to_numpy(), rows["component"].to_numpy()
            # The last row of the run of one component that a row lies in.
            ends = np.r_[(key[1:] != key[:-1]).any(axis=1) | (component[1:] != component[:-1]), True]
            last = np.flatnonzero(ends)[np.r_[0, np.cumsum(ends[:-1])]] if len(rows) else np.empty(0, int)
            found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, bool))]
            here = np.arange(len(rows))
            inside = np.flatnonzero(last > here)
            for step in range(1, MET + 1):
                for a, b in ((here, here + step), (inside, last[inside] + step)):
                    real = b < len(rows)
                    a, b = a[real], b[real]
                    same = (key[a] == key[b]).all(axis=1) & (b >= fresh)
                    a, b = a[same], b[same]
                    found.append(
                        (node[a], node[b], np.einsum("ij,ij->i", x[a], x[b]), component[a] == component[b])
                    )
            u, v, s, own = (np.concatenate(c) for c in zip(*found))
            yield _best(np.r_[u, v], np.r_[v, u], np.r_[s, s], np.r_[own, own], K // 2)
            yield _ties(u[s >= threshold], v[s >= threshold])

    return meet


def _best(u, v, s, own, k: int) -> pd.DataFrame:
    """The k best edges of each u with its own component, and with others."""
    order = np.lexsort((v, -s, own, u))
    u, v, s, own = u[order], v[order], s[order], own[order]
    cut = (u[1:] != u[:-1]) | (own[1:] != own[:-1])
    start = np.r_[0, np.flatnonzero(cut) + 1] if len(u) else np.empty(0, int)
    rank = np.arange(len(u)) - np.repeat(start, np.diff(np.r_[start, len(u)]))
    keep = rank < k
    kind = np.where(own, _OWN, _OTHER).astype(np.int32)
    return pd.DataFrame({"u": u[keep], "v": v[keep], "s": s[keep], "kind": kind[keep]})


def _local_join(threshold: float):
    """Compare the neighbours of each node with each other; rows come sorted by node."""

    def local_join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for rows in batches:
            rows = rows if tail is None else pd.concat([tail, rows], ignore_index=True)
            last = rows["at"].to_numpy()[-1] if len(rows) else None
            tail = rows[rows["at"] == last]
            yield from _joined(rows[rows["at"] != last], threshold)
        if tail is not None:
            yield from _joined(tail, threshold)

    return local_join


def _joined(rows: pd.DataFrame, threshold: float) -> Iterator[pd.DataFrame]:
    at = rows["at"].to_numpy()
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else np.zeros(1, int)
    nodes, vectors, component = rows["node"].to_numpy(), rows["vector"].to_numpy(), rows["component"].to_numpy()
    us, vs, ss, own = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, bool)]
    tied = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a < 2:
            continue
        x = np.stack(vectors[a:b])
        s = x @ x.T
        np.fill_diagonal(s, -2.0)
        i, j = np.nonzero(s >= threshold)
        tied.append((nodes[a:b][i[i < j]], nodes[a:b][j[i < j]]))
        take = min(4, b - a - 1)
        same = component[a:b, None] == component[None, a:b]
        for inside, mask in ((True, same), (False, ~same)):
            if mask.sum() == (b - a if inside else 0):
                continue
            t = np.where(mask, s, -2.0)
            near = np.argpartition(-t, take - 1, axis=1)[:, :take]
            score = np.take_along_axis(t, near, axis=1).ravel()
            real = score > -2.0
            us.append(np.repeat(nodes[a:b], take)[real])
            vs.append(nodes[a:b][near].ravel()[real])
            ss.append(score[real])
            own.append(np.full(real.sum(), inside))
    yield _best(np.concatenate(us), np.concatenate(vs), np.concatenate(ss), np.concatenate(own), 4)
    yield _ties(*(np.concatenate(c) for c in zip(*tied)))


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node and kind, and all ties."""
    near = edges.where(F.col("kind") != _TIE).groupBy("u", "v", "kind").agg(F.max("s").alias("s"))
    rank = F.row_number().over(Window.partitionBy("u", "kind").orderBy(F.desc("s"), "v"))
    near = near.withColumn("r", rank).where(F.col("r") <= k)
    return near.select("u", "v", "s", "kind").unionByName(edges.where(F.col("kind") == _TIE).distinct())


def _seeded(vectors: DataFrame, first: int, codes: int, bits: int, seed: int, threshold: float) -> DataFrame:
    schema = "c int, code long, place double, node long, grp long, component long, vector array<double>"
    coded = vectors.select("node", "grp", "bits", "component", "vector").mapInPandas(_coded(first, codes, bits, seed), schema)
    order = ["grp", "c", "code", "place", "node"]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_meet(threshold), _EDGES)


def _refined(graph: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """One round: neighbours of neighbours, met at each node."""
    near = graph.where(F.col("kind") != _TIE)
    there = near.select(F.col("u").alias("at"), F.col("v").alias("node"), "s", "kind")
    back = near.select(F.col("v").alias("at"), F.col("u").alias("node"), "s", "kind")
    rank = F.row_number().over(Window.partitionBy("at", "kind").orderBy(F.desc("s"), "node"))
    back = back.withColumn("r", rank).where(F.col("r") <= K).drop("r")
    around = there.unionByName(back).select("at", "node").distinct()
    placed = around.join(vectors.select("node", "component", F.col("unit").alias("vector")), "node")
    met = placed.repartition("at").sortWithinPartitions("at", "node").mapInPandas(_local_join(threshold), _EDGES)
    return _nearest(graph.unionByName(met), K)


def _regrouped(graph: DataFrame, found: DataFrame) -> DataFrame:
    """The lists by the components found: neighbours of the own one and of others."""
    a = found.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    b = found.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    near = graph.where(F.col("kind") != _TIE).join(a, "u", "left").join(b, "v", "left")
    own = F.coalesce(F.col("cu") == F.col("cv"), F.lit(False))
    near = near.withColumn("kind", F.when(own, F.lit(_OWN)).otherwise(F.lit(_OTHER)))
    return near.select("u", "v", "s", "kind").unionByName(graph.where(F.col("kind") == _TIE))


def _full(graph: DataFrame, threshold: float) -> bool:
    """Whether a list of other components has room for nothing but links."""
    others = graph.where((F.col("kind") == _OTHER) & (F.col("s") >= threshold))
    return not others.groupBy("u").count().where(F.col("count") >= K).isEmpty()


def _in_components(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """``vectors`` with the component of each, which is the node itself if it has no tie."""
    joined = vectors.drop("component").join(found, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def _codes(bits: int, threshold: float) -> int:
    """Codes of so many bits that two vectors at the threshold share one of."""
    agree = (1.0 - np.arccos(np.clip(threshold, -1.0, 1.0)) / np.pi) ** bits
    if agree >= 1.0 - APART:
        return CODES
    wanted = np.log(APART) / np.log1p(-agree) if agree > 0.0 else np.inf
    return int(min(MOST_CODES, max(CODES, np.ceil(wanted))))


def _audit(vectors: DataFrame, threshold: float) -> float:
    """Share of the true links of a vector that lie in its component.

    The mean over the vectors of a sample that have links, so that a large group
    counts no more than its vectors do. The sample is bounded by AUDITED.
    """
    columns = ["node", "grp", "component", "unit"]
    sample = vectors.orderBy(F.xxhash64("node")).limit(AUDITED).select(*columns).toPandas()
    groups = {
        key: (part["node"].to_numpy(), part["component"].to_numpy(), matrix(part["unit"]))
        for key, part in sample.groupby([sample["grp"], sample["unit"].map(len)])
    }

    def truth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for key, part in rows.groupby([rows["grp"], rows["unit"].map(len)]):
                if key not in groups:
                    continue
                nodes, components, x = groups[key]
                linked = x @ matrix(part["unit"]).T >= threshold
                linked &= nodes[:, None] != part["node"].to_numpy()[None, :]
                same = linked & (components[:, None] == part["component"].to_numpy()[None, :])
                yield pd.DataFrame({"node": nodes, "n": linked.sum(axis=1), "found": same.sum(axis=1)})

    # Links within a component are counted exactly, so one component is enough.
    links = vectors.select(*columns).mapInPandas(truth, "node long, n long, found long")
    shares = links.groupBy("node").agg((F.sum("found") / F.nullif(F.sum("n"), F.lit(0))).alias("share"))
    mean = shares.agg(F.avg("share")).first()[0]
    return 1.0 if mean is None else mean


def _compared(threshold: float):
    """Ties of two blocks of a label."""

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        x, nodes = matrix(rows["vector"]), rows["node"].to_numpy()
        first = (rows["block"] == rows["a"]).to_numpy()
        second = (rows["block"] == rows["b"]).to_numpy()
        i, j = np.nonzero(x[first] @ x[second].T >= threshold)
        return _ties(nodes[first][i], nodes[second][j])[["u", "v"]]

    return compared


def _counted(threshold: float):
    """Links of each node of a block with the nodes of another block of its component."""

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        x = matrix(rows["vector"])
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        first = (rows["block"] == rows["a"]).to_numpy()
        second = (rows["block"] == rows["b"]).to_numpy()
        nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        linked = x[first] @ x[second].T >= threshold
        linked &= nodes[first][:, None] != nodes[second][None, :]
        out = [pd.DataFrame({"node": nodes[first], "n": linked @ copies[second]})]
        if rows["a"].iloc[0] != rows["b"].iloc[0]:
            out.append(pd.DataFrame({"node": nodes[second], "n": copies[first] @ linked}))
        return pd.concat(out)

    return counted


def count_links(placed: DataFrame, threshold: float) -> DataFrame:
    """(node, n_links) of the nodes of each component, all compared in blocks.

    Each other node counts as often as it has copies.
    """
    keys = ["component", "grp", "a", "b"]
    cut = _blocks(placed, ["component", "grp"]).select(*keys, "block", "node", "copies", "vector")
    counted = cut.groupBy(*keys).applyInPandas(_counted(threshold), "node long, n long")
    return counted.groupBy("node").agg(F.sum("n").alias("n_links"))


def _blocks(placed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each group in blocks; a block meets every block once, itself included."""
    sizes = placed.groupBy(*keys).agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = placed.join(sizes, keys).withColumn("blocks", blocks)
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))


def compare_all(vectors: DataFrame, threshold: float) -> DataFrame:
    """u and v that tie the links of all vectors of a label, compared in blocks."""
    keys = ["grp", "a", "b"]
    cut = _blocks(vectors.select("node", "grp", F.col("unit").alias("vector")), ["grp"])
    cut = cut.select(*keys, "block", "node", "vector")
    return cut.groupBy(*keys).applyInPandas(_compared(threshold), "u long, v long")


def link_vectors(
    embeddings: DataFrame, threshold: float = 0.98, seed: int = 5, vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector.

    Vectors of one label link when their cosine, in double precision, is at least
    ``threshold``.
    """
    rows = embeddings.select("vec_id", F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.withColumn("fit", usable("vector") & F.col("label").isNotNull())
    rows = stage(
        rows.withColumn("vector", doubles("vector")).withColumn("node", F.monotonically_increasing_id()).withColumn(
            "grp", F.xxhash64(F.col("label").cast("string"), F.size("vector"))
        ),
        "vectors",
    )

    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                part["unit"] = [unit(np.asarray(v)[None, :])[0] + 0.0 for v in part["vector"]]
                part["key"] = [
                    hashlib.blake2b(np.int64(g).tobytes() + x.tobytes(), digest_size=16).digest()
                    for g, x in zip(part["grp"], part["unit"])
                ]
                part["twinned"] = [bool(x @ x >= threshold) for x in part["unit"]]
                yield part

    fit = rows.where("fit").select("node", "grp", "vector", "vec_id")
    schema = "node long, grp long, vector array<double>, vec_id long, unit array<double>, key binary, twinned boolean"
    units = stage(fit.mapInPandas(scaled, schema), "units")
    # Equal vectors are one node, the first row of them.
    firsts = units.groupBy("key").agg(
        F.min("node").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    vectors = units.select("node", "grp", "vector", "unit", "twinned").join(firsts, "node")
    # Codes of a few vectors each, whatever the size of the label.
    sizes = units.groupBy("grp").agg(F.approx_count_distinct("key").alias("size"))
    wanted = F.ceil(F.log2(F.col("size") / (4 * MET))).cast("int")
    sizes = sizes.select("grp", F.greatest(F.lit(1), F.least(F.lit(40), wanted)).alias("bits"))
    vectors = stage(vectors.join(sizes, "grp").withColumn("component", F.col("node")), "nodes")
    bits = vectors.agg(F.max("bits")).first()[0] or 1
    codes = _codes(bits, threshold)
    graph = embeddings.sparkSession.createDataFrame([], _EDGES)
    placed, first = vectors, 0
    for _ in range(1 + MORE_CODES):
        full = True
        while full:
            seeds = _seeded(placed, first, codes, bits, seed, threshold)
            graph = stage(_nearest(graph.unionByName(seeds), K), "graph")
            for _ in range(ROUNDS):
                graph = stage(_refined(graph, placed, threshold), "graph")
            first += codes
            found = stage(components(graph.where(F.col("kind") == _TIE).select("u", "v")), "found")
            full = _full(graph, threshold)
            graph = stage(_regrouped(graph, found), "graph")
            placed = stage(_in_components(vectors, found), "nodes")
        if _audit(placed, threshold) >= RECALL:
            break
    else:
        found = stage(components(compare_all(vectors, threshold)), "found")
        placed = stage(_in_components(vectors, found), "nodes")
    linked = vectors.select("node", "grp", "copies", F.col("unit").alias("vector")).join(found, "node")
    links = count_links(linked, threshold)
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    twins = F.when(F.col("twinned"), F.col("copies") - 1).otherwise(F.lit(0))
    by_key = placed.select("node", "key", "component", "copies", twins.alias("twins")).join(links, "node", "left")
    n_links = (F.col("twins") + F.coalesce("n_links", F.lit(0))).alias("n_links")
    by_key = stage(by_key.join(named, "component").select("key", "copies", n_links, "component_id"), "linked")
    by_row = attach_group_values(units.select("node", "key"), by_key, ["key"], "copies")
    out = rows.select("node", "vec_id").join(by_row.drop("key"), "node", "left")
    any_link = F.coalesce("n_links", F.lit(0)) > 0
    component = F.when(any_link, F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
