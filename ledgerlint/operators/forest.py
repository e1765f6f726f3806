"""Isolation forest (Liu, Ting and Zhou, 2008) over sale lines.

Each tree is trained on its own seeded draw of 256 sale lines, whatever the size
of the input. Scoring is a vectorised function over all lines; the trees
it carries have a fixed size. The removal threshold is an exact quantile.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.functions import predicates as p
from ledgerlint.operators.quantiles import exact_quantiles
from ledgerlint.sources.staging import stage

FEATURES = ("quantity", "price", "basket_value")
TREES = 100
TREE_ROWS = 256
DEPTH = 8
#: Lines that are dealt to a tree for each one that trains it.
OVERSAMPLING = 4
#: Larger values, infinities too, count as this in training.
LARGEST = 1e300
SCORE = "outlier_score"

_TREE_SCHEMA = "tree int, feature array<int>, split array<double>, path array<double>"

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _features() -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]


def deal(sales: DataFrame, seed: int, trees: int = TREES, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(tree, draw, features)``: the rows each tree is trained on.

    Every sale line joins each tree with the same probability, which leaves
    ``OVERSAMPLING`` times the wanted rows; it joins a run of trees that starts at
    a hashed place. Of the lines of a tree, those of the smallest hashes stay.
    One rule for every size; only lines that join a tree are shuffled.
    """
    share = min(1.0, OVERSAMPLING * tree_rows / max(sales.count(), 1))
    # No computed value: its last digit may depend on the order of a sum.
    h = F.xxhash64(F.lit(seed), "invoice", "stockcode", "quantity")
    rows = sales.select(h.alias("h"), *_features())
    part = (F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(1 << 53)) / float(1 << 53)).cast("double")
    joins = F.floor(F.lit(trees * share) + part).cast("int")
    rows = rows.withColumn("joins", F.least(joins, F.lit(trees))).where(F.col("joins") > 0)
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("joins") - 1)))
    start = F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(trees))
    rows = rows.withColumn("tree", F.pmod(start + F.col("step"), F.lit(trees)).cast("int"))
    smallest = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(3), "tree", "h"), *FEATURES)
    return rows.withColumn("draw", F.row_number().over(smallest)).where(F.col("draw") <= tree_rows)


def _expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _grow(rows: pd.DataFrame, seed: int, depth_limit: int) -> pd.DataFrame:
    """One random tree over its few rows, as a heap of nodes."""
    tree = int(rows["tree"].iloc[0])
    # No draw is possible from an infinite range.
    points = rows[list(FEATURES)].to_numpy().clip(-LARGEST, LARGEST)
    points = points[np.lexsort(points.T)]
    rng = np.random.default_rng([seed, tree])
    nodes = 2 ** (depth_limit + 1) - 1
    feature = np.full(nodes, -1)
    split, path = np.zeros(nodes), np.zeros(nodes)
    limit = min(depth_limit, math.ceil(math.log2(max(len(points), 2))))
    open_nodes = [(0, 0, points)]
    while open_nodes:
        node, depth, part = open_nodes.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth == limit or not varying.size:
            path[node] = depth + _expected_path(len(part))
            continue
        chosen = rng.choice(varying)
        # Between neighbouring numbers a draw may round up to the higher one.
        at = min(rng.uniform(low[chosen], high[chosen]), np.nextafter(high[chosen], low[chosen]))
        right = part[:, chosen] > at
        feature[node], split[node] = chosen, at
        open_nodes.append((2 * node + 1, depth + 1, part[~right]))
        open_nodes.append((2 * node + 2, depth + 1, part[right]))
    return pd.DataFrame(
        {"tree": [tree], "feature": [feature], "split": [split], "path": [path]}
    )


def grow_forest(dealt: DataFrame, seed: int, trees: int = TREES, depth: int = DEPTH) -> list:
    """Train all trees, one group per tree; one row for each reaches the driver."""
    # A fixed number of partitions, or the few small groups end up in one task.
    cores = dealt.sparkSession.sparkContext.defaultParallelism
    spread = dealt.select("tree", *FEATURES).repartition(min(trees, cores), "tree")
    grown = spread.groupBy("tree").applyInPandas(
        lambda rows: _grow(rows, seed, depth), _TREE_SCHEMA
    )
    return sorted(grown.collect(), key=lambda r: r["tree"])


def score_column(forest: list, rows_per_tree: int) -> Column:
    """Anomaly score between 0 and 1 for a sale line, null for credit lines."""
    feature = np.array([t["feature"] for t in forest], dtype=np.int64)
    path = np.array([t["path"] for t in forest])
    # A leaf leads to itself: no value exceeds its split.
    leaf = feature < 0
    split = np.where(leaf, np.inf, np.array([t["split"] for t in forest]))
    nodes = np.arange(feature.shape[1])
    depth_limit = int(math.log2(feature.shape[1] + 1)) - 1
    left = np.where(leaf, nodes, 2 * nodes + 1)
    feature = np.where(leaf, 0, feature)
    norm = _expected_path(rows_per_tree) or 1.0

    @F.pandas_udf("double")
    def score(sale: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        mask = sale.to_numpy(dtype=bool)
        points = np.concatenate([x.to_numpy()[mask] for x in (a, b, c)])
        n = len(points) // 3
        row = np.arange(n)
        depth = np.zeros(n)
        for tree_feature, tree_split, tree_left, tree_path in zip(feature, split, left, path):
            offset = tree_feature * n
            node = np.zeros(n, dtype=np.int64)
            for _ in range(depth_limit):
                value = points.take(offset.take(node) + row)
                node = tree_left.take(node) + (value > tree_split.take(node))
            depth += tree_path.take(node)
        out = np.full(len(mask), np.nan)
        out[mask] = 2.0 ** (-depth / len(feature) / norm)
        return pd.Series(out).where(mask, None)

    return score(~p.is_credit(), *_features())


def score_lines(
    lines: DataFrame, seed: int, trees: int = TREES, tree_rows: int = TREE_ROWS, depth: int = DEPTH
) -> DataFrame:
    """``lines`` with ``outlier_score``; null on credit lines."""
    sales = lines.where(~p.is_credit())
    dealt = stage(deal(sales, seed, trees, tree_rows), "dealt")
    forest = grow_forest(dealt, seed, trees, depth)
    if not forest:
        return lines.withColumn(SCORE, F.lit(None).cast("double"))
    rows_per_tree = dealt.groupBy("tree").count().agg(F.max("count")).first()[0]
    return lines.withColumn(SCORE, score_column(forest, rows_per_tree))


def remove_outliers(
    lines: DataFrame, config: CleaningConfig, parts: int | None = None
) -> DataFrame:
    """Drop the ``isolation_contam`` share of sale lines that isolate fastest.

    Credit lines always stay. Reads ``lines`` several times.
    """
    if not config.isolation_contam:
        return lines
    scored = stage(
        score_lines(
            lines, config.seed, config.isolation_trees, config.isolation_tree_rows, config.isolation_depth
        ),
        "scored",
    )
    (threshold,) = exact_quantiles(
        scored, SCORE, [1.0 - config.isolation_contam], parts=parts
    )
    outlier = p.holds(F.col(SCORE) > F.lit(threshold).cast("double"))
    return scored.where(~outlier).drop(SCORE)
