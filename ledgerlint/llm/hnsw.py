"""Approximate nearest neighbours: a navigable small-world graph for each shard.

Vectors are dealt into shards of a bounded size by a hash. Each shard builds a
hierarchical navigable small-world graph: layer l holds a random 1/M**l of the
vectors, each linked to diverse near ones. A graph is stored as flat arrays of
neighbour positions; nodes are sorted by level, so a layer is a prefix. Queries
descend the layers with a beam, many at a time, in every shard; the shards' best
are scored again in double precision and merged.

Equal vectors are one node, named by their smallest vec_id. A table holds the
smallest vec_ids of each node, and hits are expanded to them when results are
merged, so a group of copies takes one place of a beam and one of a list of links.

The largest inner product becomes the nearest direction by one more coordinate
that gives all vectors of a shard the same length (0 for queries).

Queries are worked in blocks, each against each shard. A layer with no more nodes
than the beam is searched whole, so tables of a few vectors get exact results.

Cases: null, zero and non-finite vectors and rows without vec_id take no part;
vectors are compared with those of their own length only; candidates that share a
query's vec_id are its own row; repeated rows are candidates of their own; ties go
to the smaller vec_id; other columns are dropped.
"""

from __future__ import annotations



import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.vectors import doubles, matrix, usable
from ledgerlint.sources.staging import stage

#: Links of a node (twice as many in the lowest layer), and the beams.
M = 16
BUILD_BEAM = 64
SEARCH_BEAM = 192
#: Vectors of a shard and queries of a block, on average.
SHARD = 8192
QUERIES = 8192
#: Nodes added at a time, queries searched at a time, nodes expanded at a time.
ADDED = 512
SEARCHED = 256
WIDE = 4


def beam_search(x, links, queries, start, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and similarities of the best found for each query, best first.

    ``links`` are the neighbour positions of each node, -1 where there is none;
    ``start`` holds the positions each query begins with, -1 likewise.
    """
    n, q = len(links), len(queries)
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, n] = True  # position -1
    rows = np.arange(q)
    seen[rows[:, None], start] = True
    at = np.full((q, beam), -1, dtype=np.int64)
    sim = np.full((q, beam), -np.inf, dtype=np.float32)
    width = min(beam, start.shape[1])
    first = np.where(start >= 0, np.einsum("qkd,qd->qk", x[start], queries), -np.inf)
    order = np.argsort(-first, axis=1, kind="stable")[:, :width]
    at[:, :width] = np.take_along_axis(start, order, axis=1)
    sim[:, :width] = np.take_along_axis(first, order, axis=1)
    done = ~np.isfinite(sim)
    active = rows
    while len(active):
        # The best nodes of each beam that have not been expanded.
        rank = np.cumsum(~done[active], axis=1)
        chosen = ~done[active] & (rank <= WIDE)
        some = chosen.any(axis=1)
        active, chosen = active[some], chosen[some]
        if not len(active):
            break
        done[active] |= chosen
        nodes = np.full((len(active), WIDE), -1, dtype=np.int64)
        r, c = np.nonzero(chosen)
        nodes[r, np.cumsum(chosen, axis=1)[r, c] - 1] = at[active][r, c]
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(active), -1)
        fresh = ~seen[active[:, None], near]
        r, c = np.nonzero(fresh)
        p = near[r, c]
        # A node met twice in one step counts once.
        _, once = np.unique(r * (n + 1) + p, return_index=True)
        r, p = r[once], p[once]
        seen[active[r], p] = True
        s = np.einsum("ij,ij->i", x[p], queries[active[r]])
        counts = np.bincount(r, minlength=len(active))
        most = int(counts.max(initial=0))
        if not most:
            continue
        slot = np.arange(len(r)) - np.repeat(np.cumsum(counts) - counts, counts)
        new_at = np.full((len(active), most), -1, dtype=np.int64)
        new_sim = np.full((len(active), most), -np.inf, dtype=np.float32)
        new_at[r, slot], new_sim[r, slot] = p, s
        all_at = np.concatenate([at[active], new_at], axis=1)
        all_sim = np.concatenate([sim[active], new_sim], axis=1)
        all_done = np.concatenate([done[active], ~np.isfinite(new_sim)], axis=1)
        order = np.argsort(-all_sim, axis=1, kind="stable")[:, :beam]
        at[active] = np.take_along_axis(all_at, order, axis=1)
        sim[active] = np.take_along_axis(all_sim, order, axis=1)
        done[active] = np.take_along_axis(all_done, order, axis=1)
    return at, sim


def diverse(x, around, near, sim, links: int) -> np.ndarray:
    """Up to ``links`` of the candidates of each node, best first.

    A candidate is taken when it is nearer to the node than to all taken before;
    places that are left go to the best of the others.
    """
    out = np.full((len(near), links), -1, dtype=np.int64)
    for a in range(0, len(near), 256):
        block, s = near[a : a + 256], sim[a : a + 256]
        order = np.argsort(-s, axis=1, kind="stable")
        block, s = np.take_along_axis(block, order, axis=1), np.take_along_axis(s, order, axis=1)
        real = (block >= 0) & np.isfinite(s)
        v = x[block]
        among = v @ v.transpose(0, 2, 1)
        taken = np.zeros(block.shape, dtype=bool)
        closest = np.full(block.shape, -np.inf, dtype=np.float32)
        for c in range(block.shape[1]):
            take = real[:, c] & (closest[:, c] < s[:, c])
            taken[:, c] = take
            closest[take] = np.maximum(closest[take], among[take, c])
        order = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :links]
        kept = np.take_along_axis(np.where(real, block, -1), order, axis=1)
        out[a : a + 256, : kept.shape[1]] = kept
    return out


class Graph:
    """The layers of one shard; ``x`` has rows of length one, sorted by level."""

    def __init__(self, x: np.ndarray, sizes: list[int]):
        self.x, self.sizes, self.layers = x, sizes, []

    @classmethod
    def build(cls, x: np.ndarray, seed: int) -> tuple[Graph, np.ndarray]:
        """The graph, and the order in which it holds the rows of ``x``."""
        rng = np.random.default_rng(seed)
        levels = np.floor(-np.log(1.0 - rng.random(len(x))) / np.log(M)).astype(int)
        order = np.argsort(-levels, kind="stable")
        sizes = [int((levels >= level).sum()) for level in range(int(levels.max(initial=0)) + 1)]
        graph = cls(x[order], sizes)
        for level in range(len(sizes) - 1, -1, -1):
            graph.layers.insert(0, graph._layer(sizes[level], 2 * M if level == 0 else M))
        return graph, order

    def _layer(self, n: int, links: int) -> np.ndarray:
        """Links among the first n nodes; layers above are complete."""
        x, out = self.x, np.full((n, links), -1, dtype=np.int64)
        size = 0
        while size < n:
            batch = np.arange(size, min(n, size + max(64, min(ADDED, size))))
            near = np.full((len(batch), 0), -1, dtype=np.int64)
            sim = np.empty((len(batch), 0), dtype=np.float32)
            if size:
                start = self._descend(x[batch], size)
                near, sim = beam_search(x, out[:size], x[batch], start, BUILD_BEAM)
            own = x[batch] @ x[batch].T
            np.fill_diagonal(own, -np.inf)
            k = min(BUILD_BEAM, len(batch) - 1)
            if k:
                best = np.argpartition(-own, k - 1, axis=1)[:, :k]
                near = np.concatenate([near, batch[best]], axis=1)
                sim = np.concatenate([sim, np.take_along_axis(own, best, axis=1)], axis=1)
            size = batch[-1] + 1
            if near.shape[1]:
                out[batch] = diverse(x, batch, near, sim, links)
                self._link_back(out, batch, links)
        return out

    def _link_back(self, out: np.ndarray, batch: np.ndarray, links: int) -> None:
        """Links from the neighbours of new nodes back to them."""
        to, frm = out[batch].ravel(), np.repeat(batch, links)
        real = to >= 0
        to, frm = to[real], frm[real]
        s = np.einsum("ij,ij->i", self.x[to], self.x[frm])
        order = np.lexsort((-s, to))
        to, frm = to[order], frm[order]
        head = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        counts = np.diff(np.r_[head, len(to)])
        slot = np.arange(len(to)) - np.repeat(head, counts)
        nodes = to[head]
        # The nearest come first; more than a full list of them cannot be kept.
        fits = slot < links
        new = np.full((len(nodes), links), -1, dtype=np.int64)
        new[np.repeat(np.arange(len(nodes)), counts)[fits], slot[fits]] = frm[fits]
        both = np.concatenate([out[nodes], new], axis=1)
        both = np.sort(both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        full = (both >= 0).sum(axis=1) > links
        loose = -np.sort(-both[~full], axis=1)[:, :links]
        out[nodes[~full]] = loose
        if full.any():
            chosen, near = nodes[full], both[full]
            sim = np.where(near >= 0, np.einsum("nkd,nd->nk", self.x[near], self.x[chosen]), -np.inf)
            out[chosen] = diverse(self.x, chosen, near, sim.astype(np.float32), links)

    def _descend(self, queries: np.ndarray, below: int) -> np.ndarray:
        """Positions to begin with in the layer under the finished ones."""
        start = np.tile(np.arange(min(below, self.sizes[-1], SEARCH_BEAM)), (len(queries), 1))
        for links in reversed(self.layers):
            start, _ = beam_search(self.x, links, queries, start, M)
            start = np.where(start < below, start, -1)
        return start

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Positions of the best found for each query, best first."""
        out = []
        n = self.sizes[0]
        for a in range(0, len(queries), SEARCHED):
            part = queries[a : a + SEARCHED]
            start = np.tile(np.arange(min(self.sizes[-1], SEARCH_BEAM)), (len(part), 1))
            for level in range(len(self.layers) - 1, 0, -1):
                start, _ = beam_search(self.x, self.layers[level], part, start, M)
            if n <= beam:
                start = np.tile(np.arange(n), (len(part), 1))
            out.append(beam_search(self.x, self.layers[0], part, start, beam)[0])
        return np.concatenate(out)


_INDEX = "shard int, dim int, ids binary, nodes binary, many binary, vectors binary, sizes array<int>, links binary"


def _built(seed: int):
    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "vec_id", "node"], kind="stable")
        vectors = matrix(rows["vector"])
        graph, order = Graph.build(_lifted(vectors), seed)
        links = np.concatenate([x.astype("<i4").ravel() for x in graph.layers])
        ids = rows["vec_id"].to_numpy()[order].astype("<i8")
        nodes = rows["node"].to_numpy()[order].astype("<i8")
        many = rows["many"].to_numpy()[order].astype(np.uint8)
        return pd.DataFrame(
            {"shard": [int(rows["shard"].iloc[0])], "dim": [vectors.shape[1]], "ids": [ids.tobytes()],
             "nodes": [nodes.tobytes()], "many": [many.tobytes()],
             "vectors": [vectors[order].astype("<f8").tobytes()], "sizes": [graph.sizes], "links": [links.tobytes()]}
        )

    return built


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one: scaled by the longest, with one more coordinate."""
    longest = np.abs(vectors).max()
    x = vectors / longest
    squares = (x * x).sum(axis=1)
    most = squares.max()
    return (np.hstack([x, np.sqrt(np.maximum(most - squares, 0.0))[:, None]]) / np.sqrt(most)).astype(np.float32)


def distinct(embeddings: DataFrame, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """One row for each vector that differs (node, vec_id, many, vector, dim), and all rows by node key.

    vec_id is the smallest; many tells whether there is another.
    """
    fit = embeddings.where(usable(vector) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), doubles(vector).alias("vector"), F.size(vector).alias("dim")
    )
    # Adding 0.0 makes -0.0 equal to it.
    key = F.md5(F.transform("vector", lambda x: x + F.lit(0.0)).cast("string"))
    rows = stage(fit.withColumn("row", F.monotonically_increasing_id()).withColumn("key", key), "rows")
    firsts = rows.groupBy("key").agg(
        F.min("row").alias("node"), F.min("vec_id").alias("vec_id"),
        (F.min("vec_id") < F.max("vec_id")).alias("many"), (F.count("*") > 1).alias("repeated"),
    )
    held = rows.select(F.col("row").alias("node"), "vector", "dim")
    return stage(firsts.join(held, "node"), "distinct"), rows.select("key", "vec_id")


def twins(vectors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """node and the vec_ids to expand it to, for nodes of several rows.

    These are the k + 1 smallest and how often each occurs, up to k times, so k are
    left when one of them is the query's own.
    """
    counted = rows.groupBy("key", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = counted.withColumn("r", rank).where(F.col("r") <= k + 1)
    lists = few.groupBy("key").agg(F.collect_list(F.struct("vec_id", "n")).alias("twins"))
    return vectors.where("repeated").select("key", "node").join(lists, "key").select("node", "twins")


def build(vectors: DataFrame, seed: int = 3) -> DataFrame:
    """The index of ``distinct`` vectors: one row for each shard, with its graph as flat arrays."""
    # One row for each vector length.
    sizes = vectors.groupBy("dim").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    h = F.xxhash64(F.lit(seed), "vec_id")
    dealt = vectors.join(sizes, "dim").withColumn("h", h).withColumn("shard", F.pmod("h", "shards").cast("int"))
    dealt = dealt.select("dim", "shard", "h", "node", "vec_id", "many", "vector")
    # A task for each few shards: by their bytes they would be put together into one.
    spark = vectors.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = dealt.repartition(tasks, "dim", "shard")
    return stage(dealt.groupBy("dim", "shard").applyInPandas(_built(seed), _INDEX), "index")


def _found(k: int, beam: int):
    def found(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "node", "vec_id", "score"]
        if not len(index) or not len(queries):
            return pd.DataFrame({c: [] for c in columns})
        row = index.iloc[0]
        dim, sizes = int(row["dim"]), [int(n) for n in row["sizes"]]
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        ids, nodes = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nodes"], "<i8")
        many = np.frombuffer(row["many"], np.uint8).astype(bool)
        graph = Graph(_lifted(vectors), sizes)
        flat, at = np.frombuffer(row["links"], "<i4").astype(np.int64), 0
        for level, n in enumerate(sizes):
            width = 2 * M if level == 0 else M
            graph.layers.append(flat[at : at + n * width].reshape(n, width))
            at += n * width
        queries = queries.sort_values("query_id", kind="stable")
        wanted, names = matrix(queries["query"]), queries["query_id"].to_numpy()
        scaled = wanted / np.abs(wanted).max(axis=1, keepdims=True)
        scaled /= np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
        scaled = np.hstack([scaled, np.zeros((len(scaled), 1))]).astype(np.float32)
        near = graph.search(scaled, max(beam, 4 * k))
        out = []
        for name, q, positions in zip(names, wanted, near):
            positions = positions[positions >= 0]
            positions = positions[(ids[positions] != name) | many[positions]]
            scores = vectors[positions] @ q
            # One more than k, as a node may hold the query's own row.
            best = np.lexsort((ids[positions], -scores))[: k + 1]
            positions = positions[best]
            out.append(
                pd.DataFrame(
                    {"query_id": name, "node": nodes[positions], "vec_id": ids[positions], "score": scores[best]}
                )
            )
        return pd.concat(out)

    return found


def search(
    index: DataFrame, copies: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each query.

    ``queries`` has query_id and query (an array of doubles); ``copies`` are the
    ``twins`` of the index for this k.
    """
    sized = queries.withColumn("dim", F.size("query"))
    counts = sized.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    # Every block of queries goes to every shard, as every query is a query to all rows.
    blocks = sized.join(counts, "dim").join(shards, "dim").withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last"))))
    blocks = blocks.select("dim", "shard", "block", "query_id", "query")
    placed = index.join(counts, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("dim", "shard", "block", "ids", "nodes", "many", "vectors", "sizes", "links")
    key = ["dim", "shard", "block"]
    found = placed.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(
        _found(k, beam), "query_id long, node long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    hits = found.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")
    own = F.array(F.struct("vec_id", F.lit(1).cast("long").alias("n")))
    hits = hits.join(copies, "node", "left").withColumn("one", F.explode(F.coalesce("twins", own)))
    hits = hits.where(F.col("one.vec_id") != F.col("query_id")).select(
        "query_id", "score", F.col("one.vec_id").alias("vec_id"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("one.n"))).alias("copy"),
    )
    best = hits.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def every_nth(embeddings: DataFrame, step: int = 20, vector: str = "embedding") -> DataFrame:
    """The rows whose vec_id is divisible by ``step``, as queries."""
    chosen = embeddings.where((F.col("vec_id") % step == 0) & usable(vector))
    return chosen.select(F.col("vec_id").cast("long").alias("query_id"), doubles(vector).alias("query"))


def nearest(embeddings: DataFrame, step: int = 20, k: int = 20, beam: int = SEARCH_BEAM) -> DataFrame:
    vectors, rows = distinct(embeddings)
    copies = stage(twins(vectors, rows, k), "twins")
    return search(build(vectors), copies, every_nth(embeddings, step), k, beam)
