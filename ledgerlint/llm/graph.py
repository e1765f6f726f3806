"""Connected components by alternating stars.

Each round hangs the larger neighbours of every node, then the smaller ones, on
its smallest neighbour, until every component is a star (large-star, small-star).
The number of rounds grows with the logarithm of the size of a component; a hub's
neighbours are combined before they are shuffled.

Up to ``FEW`` edges, a megabyte or two, are joined in one task instead: the component
of a node is its smallest node either way, and rounds of many small tasks cost more
than the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import gives_back
from ledgerlint.sources.staging import discard, stage

FEW = 1 << 17


def _print(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(mixed.bitwiseAND(F.lit((1 << 40) - 1)))).first())


def least_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # Roots are hung on smaller roots, then every path is cut short.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


@gives_back
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    u, v = (
        np.concatenate([np.empty(0, np.int64), *(b.column(i).to_numpy() for b in held)]) for i in range(2)
    )
    nodes, least = least_labels(u, v)
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "component": pa.array(least, pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the edges (u, v), whole numbers; stored."""
    pairs = edges.where("u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    )
    stars = stage(pairs.distinct(), "stars")
    if stars.count() <= FEW:
        found = stage(stars.coalesce(1).mapInArrow(_joined, "node long, component long"), "components")
    else:
        stars = _starred(stars)
        named = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        found = stage(named.unionByName(roots), "components")
    discard(stars)
    return found


def _starred(stars: DataFrame) -> DataFrame:
    """Every node that is not its component's smallest, beside the smallest."""
    before = _print(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        next_stars = stage(hung.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars")
        discard(stars)
        stars, after = next_stars, _print(next_stars)
        if after == before:
            break
        before = after
    return stars
