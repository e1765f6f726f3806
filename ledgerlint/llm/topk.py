"""Exact top-k search by inner product: a three-phase uniform threshold.

Components become the integers floor(1024 * x), so scores are exact. The
components of a vector are cut into ``LISTS`` runs; the inner product over one run
is a candidate's local score in that list, and a score is the sum of its local
scores. Rows are dealt into shards of a bounded size and queries into blocks; a
shard holds all lists of its rows, so the sums of a row are made where it lies
and only bounded lists of scores travel.

1. Every shard takes the best of each of its lists, adds up their scores, and
   gathers the k best. The k-th best of all shards is a cutoff that no row of the
   result falls below.
2. The cutoff goes to all shards with the block of its query. A row reaches it
   only if a list holds it with at least the cutoff divided by the number of lists:
   the uniform threshold. Those entries are collected.
3. An entry seen in some lists only is bounded by the threshold in the others;
   what the bound does not exclude is added up exactly, and the best k of each
   shard are merged.

Equal vectors are one candidate and one query, with the smallest vec_ids and their
counts in a table that results are expanded from; a group of copies of any size
takes one place. As a query's own row may be among the best, one more is sought.

Cases: vectors that are null or hold null or non-finite components and rows
without vec_id take no part; zero and empty vectors do; vectors are compared with
those of their own length only; repeated rows are candidates, and queries, of
their own, and only the query's own row is left out; ties go to the smaller
vec_id; a local score of 2 ** 60 or more raises an error; other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ledgerlint.llm.vectors import doubles
from ledgerlint.sources.staging import stage

#: Lists a vector is cut into; scores gathered in the first phase, for each wanted.
LISTS = 2
GATHERED = 4
#: Rows of a shard and queries of a block, on average; scores held at a time.
SHARD = 8192
QUERIES = 8192
HELD = 1 << 21
EXACT = 2.0**53
#: Local scores stay below this, so that their sums and bounds fit in 64 bits.
LARGEST = 2**60
NONE = -(2**62)
UNIT = ["dim", "shard", "block"]


def whole(vector: str = "embedding") -> Column:
    """True for vectors without null or non-finite components; zero vectors count."""
    finite = F.forall(doubles(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x), held as doubles: scaling and rounding down are exact."""
    return np.floor(1024.0 * vectors)


def local_scores(queries: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Scores of all rows for all queries in each list, as 64-bit integers."""
    out = []
    for q, x in zip(np.array_split(queries, LISTS, axis=1), np.array_split(rows, LISTS, axis=1)):
        reach = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(1, q.shape[1])
        out.append((q @ x.T).astype(np.int64) if reach < EXACT else _long_products(q, x))
    return out


def _long_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products where doubles would round: in Python's integers."""
    if not (np.isfinite(q).all() and np.isfinite(x).all()):
        raise OverflowError("a component does not fit in 64 bits")
    a = [[int(v) for v in row] for row in q]
    b = [[int(v) for v in row] for row in x]
    found = [[sum(s * t for s, t in zip(u, v)) for v in b] for u in a]
    if any(abs(v) >= LARGEST for line in found for v in line):
        raise OverflowError("a score does not fit in 64 bits")
    return np.array(found, dtype=np.int64).reshape(len(q), len(x))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest of each row, in any order."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def gather(queries: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """First phase: the k best scores among the heads of a shard's lists, for each query.

    ``NONE`` fills up what is missing.
    """
    lists = local_scores(queries, rows)
    heads = np.sort(np.concatenate([_best(s, GATHERED * k) for s in lists], axis=1), axis=1)
    scores = sum(np.take_along_axis(s, heads, axis=1) for s in lists)
    # A row that heads several lists counts once.
    scores = np.where(np.diff(heads, axis=1, prepend=-1) > 0, scores, NONE)
    return -np.sort(-scores, axis=1)[:, : min(k, rows.shape[0])]


def collect(queries: np.ndarray, rows: np.ndarray, cutoffs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Second and third phase: query, row and score of what reaches the cutoffs."""
    lists = local_scores(queries, rows)
    least = -(-cutoffs // LISTS)[:, None]  # rounded up: list scores are integers
    seen = [s >= least for s in lists]
    at = np.nonzero(np.logical_or.reduce(seen))
    known = sum(np.where(i[at], s[at], least[at[0], 0] - 1) for i, s in zip(seen, lists))
    open_ones = known >= cutoffs[at[0]]
    q, row = at[0][open_ones], at[1][open_ones]
    scores = sum(s[q, row] for s in lists)
    reached = scores >= cutoffs[q]
    return q[reached], row[reached], scores[reached]


def _arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dim = int(row.dim)
    queries = np.frombuffer(row.queries, "<f8").reshape(-1, dim) if dim else np.zeros((len(row.query_ids) // 8, 0))
    rows = np.frombuffer(row.rows, "<f8").reshape(-1, dim) if dim else np.zeros((len(row.row_ids) // 8, 0))
    return np.frombuffer(row.query_ids, "<i8"), queries, np.frombuffer(row.row_ids, "<i8"), rows


def _steps(queries: int, rows: int) -> list[slice]:
    step = max(1, HELD // max(1, rows))
    return [slice(a, a + step) for a in range(0, queries, step)]


def _gathered(k: int):
    def gathered(units: pd.DataFrame) -> pd.DataFrame:
        query_ids, queries, _, rows = _arrays(next(units.itertuples(index=False)))
        found = []
        for part in _steps(len(queries), len(rows)):
            scores = gather(queries[part], rows, k)
            found.append(
                pd.DataFrame({"query": np.repeat(query_ids[part], scores.shape[1]), "score": scores.ravel()})
            )
        return pd.concat(found)

    return gathered


def _collected(k: int):
    def collected(units: pd.DataFrame) -> pd.DataFrame:
        unit = next(units.itertuples(index=False))
        query_ids, queries, row_ids, rows = _arrays(unit)
        cutoffs, firsts = np.frombuffer(unit.cutoffs, "<i8"), np.frombuffer(unit.firsts, "<i8")
        found = []
        for part in _steps(len(queries), len(rows)):
            q, row, scores = collect(queries[part], rows, cutoffs[part])
            # The best k of a shard are enough: ties go to the smaller vec_id.
            order = np.lexsort((firsts[row], -scores, q))
            q, row, scores = q[order], row[order], scores[order]
            few = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
            q, row, scores = q[few], row[few], scores[few]
            found.append(
                pd.DataFrame(
                    {"query": query_ids[part][q], "node": row_ids[row], "vec_id": firsts[row], "score": scores}
                )
            )
        return pd.concat(found)

    return collected


def distinct(embeddings: DataFrame, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """One row for each integer vector (node, vec_id, dim, vector), and node and vec_id of all rows."""
    fit = embeddings.where(whole(vector) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), doubles(vector).alias("vector"), F.size(vector).alias("dim")
    )

    def integer(x: Column) -> Column:
        # Doubles of 2 ** 53 and more are integers; adding 0.0 makes -0.0 equal to it.
        scaled = F.lit(1024.0) * x
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled) + F.lit(0.0)

    key = F.md5(F.transform("vector", integer).cast("string"))
    rows = stage(fit.withColumn("row", F.monotonically_increasing_id()).withColumn("key", key), "rows")
    firsts = rows.groupBy("key").agg(F.min("row").alias("node"), F.min("vec_id").alias("vec_id"))
    nodes = stage(firsts.join(rows.select(F.col("row").alias("node"), "vector", "dim"), "node"), "nodes")
    # Hot keys are combined before the shuffle; counted rows are few for a group of copies.
    named = rows.groupBy("key", "vec_id").agg(F.count("*").alias("n"))
    return nodes, named.join(nodes.select("key", "node"), "key").select("node", "vec_id", "n")


def _packed(first: str, *more: str):
    """Rows of a shard, or a block, as flat arrays in the order of their ids."""

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(first, kind="stable")
        dim = int(rows["dim"].iloc[0])
        vectors = np.array([np.asarray(v, dtype=np.float64) for v in rows["vector"]]).reshape(len(rows), dim)
        out = {"dim": [dim], "part": [int(rows["part"].iloc[0])], "vectors": [integers(vectors).astype("<f8").tobytes()]}
        for name in (first, *more):
            out[name] = [rows[name].to_numpy(np.int64).astype("<i8").tobytes()]
        return pd.DataFrame(out)

    return packed


def _blocks(vectors: DataFrame, rows: int, names: tuple[str, ...], seed: int) -> DataFrame:
    """Vectors dealt by a hash of the node into parts, one row for each part.

    A part has about ``rows`` vectors of 64 components, or fewer of longer ones.
    """
    parts = F.ceil(F.count("*") * F.greatest(F.col("dim"), F.lit(64)) / (64 * rows)).cast("int")
    sizes = vectors.groupBy("dim").agg(parts.alias("parts"))
    dealt = vectors.join(sizes, "dim").withColumn(
        "part", F.pmod(F.xxhash64(F.lit(seed), "node"), "parts").cast("int")
    ).select("dim", "part", "vector", *names)
    schema = "dim int, part int, vectors binary, " + ", ".join(f"{n} binary" for n in names)
    return dealt.groupBy("dim", "part").applyInPandas(_packed(*names), schema)


def _units(shards: DataFrame, blocks: DataFrame) -> GroupedData:
    """Every block of queries beside every shard of its length: one bounded row each."""
    last = shards.groupBy("dim").agg(F.max("part").alias("last_shard"))
    ends = blocks.groupBy("dim").agg(F.max("part").alias("last_block"))
    # Part numbers are few; a part that got no row meets nothing.
    left = shards.join(ends, "dim").select(
        "dim", F.col("part").alias("shard"), F.explode(F.sequence(F.lit(0), "last_block")).alias("block"),
        F.col("vectors").alias("rows"), F.col("node").alias("row_ids"), F.col("vec_id").alias("firsts"),
    )
    right = blocks.join(last, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), "last_shard")).alias("shard"), F.col("part").alias("block"),
        F.col("vectors").alias("queries"), F.col("node").alias("query_ids"),
        *(c for c in ("cutoffs",) if c in blocks.columns),
    )
    # One task for each few units, which are alike in size.
    spark = shards.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return left.join(right, UNIT).repartition(tasks, *UNIT).groupBy(*UNIT)


def search(nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, node, vec_id and score of the k best nodes of each query node, itself included.

    Both have node, vec_id, dim and vector, where equal vectors share a row.
    """
    shards = stage(_blocks(nodes, SHARD, ("node", "vec_id"), 11), "shards")
    blocks = stage(_blocks(queries, QUERIES, ("node",), 13), "blocks")
    gathered = _units(shards, blocks).applyInPandas(_gathered(k), "query long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    best = gathered.where(F.col("score") > NONE).withColumn("r", rank).where(F.col("r") <= k)
    # Fewer rows than wanted have no cutoff.
    cutoffs = best.groupBy(F.col("query").alias("node")).agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(NONE)).alias("cutoffs")
    )
    bounded = stage(queries.join(cutoffs, "node"), "bounded")
    blocks = stage(_blocks(bounded, QUERIES, ("node", "cutoffs"), 13), "bounded-blocks")
    found = _units(shards, blocks).applyInPandas(_collected(k), "query long, node long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def top_k(embeddings: DataFrame, step: int = 100, k: int = 10, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows that score highest for every ``step``-th vec_id."""
    nodes, rows = distinct(embeddings, vector)
    rows = stage(rows, "members")
    asked = rows.where(F.col("vec_id") % step == 0)
    queries = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    found = stage(search(nodes, queries, k + 1), "found")
    # The k + 1 smallest vec_ids of a node that was found, with up to k + 1 copies each.
    rank = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    few = rows.join(found.select("node").distinct(), "node", "left_semi").withColumn("r", rank)
    lists = few.where(F.col("r") <= k + 1).groupBy("node").agg(
        F.collect_list(F.struct("vec_id", F.least("n", F.lit(k + 1)).alias("n"))).alias("members")
    )
    hits = found.select("query", "node", "score").join(lists, "node").select(
        "query", "node", "score", F.inline("members")
    )
    # Only the best k + 1 rows of a query node are needed for any of its rows.
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    best = hits.withColumn("before", before).where(F.col("before") <= k).groupBy("query").agg(
        F.collect_list(F.struct("score", "node", "vec_id", "n")).alias("hits")
    )
    copies = asked.select(F.col("node").alias("query"), F.col("vec_id").alias("query_id"), F.expr(
        "explode(sequence(1L, n))").alias("copy"))
    hit = F.col("hit")
    own = (hit["node"] == F.col("query")) & (hit["vec_id"] == F.col("query_id"))
    # A query's own row is one of the copies of its vec_id at its own node.
    left = F.when(own, hit["n"] - 1).otherwise(hit["n"])
    expanded = (
        copies.join(best, "query").withColumn("hit", F.explode("hits")).withColumn("left", left).where("left > 0")
        .select("query", "query_id", "copy", hit["score"].alias("score"), hit["vec_id"].alias("vec_id"),
                F.expr("explode(sequence(1L, left))").alias("twin"))
    )
    last = Window.partitionBy("query", "query_id", "copy").orderBy(F.desc("score"), "vec_id", "twin")
    ranked = expanded.withColumn("rank", F.row_number().over(last).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
