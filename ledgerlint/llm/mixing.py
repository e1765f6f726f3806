"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target in words. A document is taken ``floor(r)`` times, where
``r`` is target over source size, and once more with the probability that is
left. These probabilities are rounded together: two documents with fractional
mass (probability times size) exchange words at random, one way or the other,
until one of them is whole or empty, so the words of a source never drift from
its target. Documents are dealt into chunks of a source; the one fractional
document that a chunk leaves goes up a tree of chunks, and the last of a source
is rounded alone: the words taken miss the target by less than one document.

Random numbers come from seeded hashes of the source and chunk, and a chunk is
worked in the order of hashed ids, so that reruns agree whatever the
partitioning.

Rows that are alike are counted before they are shuffled and dealt in pieces of
``ALIKE``, so that a row repeated without end fills no chunk. The plan of the
sources is a table as well: only its sums reach the driver.

Cases: a null text has size 0; a null source is a source of its own, after all
others; documents of size 0 take no part and are taken 0 words; repeated rows
are documents of their own; other columns are kept.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import packed, row_key, unpacked
from ledgerlint.sources.staging import stage

#: Documents of a chunk on average, and chunks that meet in one of the next level.
CHUNK_ROWS = 4096
FAN_IN = 64
#: Rows alike that are dealt together, and copies of a row that one task writes.
ALIKE = 64
MANY = 1024


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame, slots: int) -> DataFrame:
    """``sources`` with slot: the place by code point, null last, modulo ``slots``.

    Places are counted inside range partitions and shifted by the rows of those before,
    of which there is one count each.
    """
    order = F.col("source").asc_nulls_last()
    dealt = stage(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    place = F.col("offset") + F.col("inside") - 1
    return dealt.withColumn("inside", inside).join(offsets, "part").select(
        "source", "size", "rows", F.pmod(place, F.lit(slots)).cast("int").alias("slot")
    )


def water_level(sources: DataFrame, weights: Sequence[float], total: float, most: float) -> float:
    """Words for each unit of weight when no source gets more than ``most`` times its size.

    ``sources`` (size, slot) stays where it is: each round adds up the sources that the
    level fills, one row for each slot, and reshares what they leave. The level only
    rises; rounds end when it fills no further source.
    """

    def add_up(rows: DataFrame) -> tuple[int, float, float]:
        found = rows.groupBy("slot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found.sort(key=lambda r: r["slot"])
        return (
            sum(r["n"] for r in found), float(sum(r["size"] for r in found)),
            sum(weights[r["slot"]] * r["n"] for r in found),
        )

    n_all, _, weight = add_up(sources)
    level, n_full = (float(total) / weight if n_all else 0.0), 0
    while True:
        n, size, taken = add_up(sources.where(_fills(level, weights, most)))
        if n == n_all:
            return math.inf
        if n <= n_full:
            return level
        n_full, level = n, max(level, max(total - most * size, 0.0) / (weight - taken))


def _weight(weights: Sequence[float]) -> Column:
    return F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("slot") + 1)


def _fills(level: float, weights: Sequence[float], most: float) -> Column:
    return F.lit(level) * _weight(weights) >= F.lit(float(most)) * F.col("size")


def source_plan(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target, ratio and chunks of each source, stored.

    ``sized`` holds source, size and n, how many rows are alike. However many sources
    there are, only sums over all of them reach the driver.
    """
    rows = F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("rows")
    found = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), rows)
    ranked = stage(_ranked(found, len(weights)), "ranked")
    total = share * (ranked.agg(F.sum("size")).first()[0] or 0)
    level = water_level(ranked, weights, total, most)
    limit = F.lit(float(most)) * F.col("size")
    full = F.lit(True) if math.isinf(level) else _fills(level, weights, most)
    target = F.when(full, limit).otherwise(F.lit(0.0 if math.isinf(level) else level) * _weight(weights))
    plan = ranked.withColumn("target", target).select(
        "source", F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias("ratio"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / CHUNK_ROWS)).cast("int").alias("chunks"),
    )
    return stage(plan, "source-plan")


def pivot(sizes: np.ndarray, mass: np.ndarray, rng: random.Random) -> np.ndarray:
    """Masses after the exchange: all 0 or the size, but for one at most."""
    out = mass.copy()
    held = -1
    for i in range(len(out)):
        if not 0.0 < out[i] < sizes[i]:
            continue
        if held < 0:
            held = i
            continue
        a, b, sa, sb = out[held], out[i], sizes[held], sizes[i]
        up, down = min(sa - a, b), min(a, sb - b)
        if rng.random() * (up + down) < down:  # words go from i to the held one
            fills, a, b = sa - a <= b, a + up, b - up
            if fills:
                out[held], out[i] = sa, b
                held = i if 0.0 < b < sb else -1
            else:
                out[held], out[i] = a, 0.0
                held = held if 0.0 < a < sa else -1
        else:
            empties, a, b = a <= sb - b, a - down, b + down
            if empties:
                out[held], out[i] = 0.0, b
                held = i if 0.0 < b < sb else -1
            else:
                out[held], out[i] = a, sb
                held = held if 0.0 < a < sa else -1
    return out


def _rng(*parts) -> random.Random:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return random.Random(int.from_bytes(digest, "little"))


def _round(seed: int, level: int, last: bool):
    def round_chunk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "row", "piece", "size"], kind="stable")
        rows = rows.loc[rows.index.repeat(rows["n"])].reset_index(drop=True)  # alike, but rows of their own
        rows["n"] = 1
        source, group = rows["source"].iloc[0], int(rows["parent"].iloc[0])
        rng = _rng(seed, level, None if pd.isna(source) else source, group)
        mass = pivot(rows["size"].to_numpy(float), rows["mass"].to_numpy(float), rng)
        if last:
            size = rows["size"].to_numpy(float)
            for i in np.flatnonzero((mass > 0) & (mass < size)):
                mass[i] = size[i] if rng.random() * size[i] < mass[i] else 0.0
        rows["mass"] = mass
        return rows

    return round_chunk


def decide(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: float = 3.0,
    seed: int = 17, size: Column | None = None, source: str = "source",
) -> DataFrame:
    """How often the mix takes each document of ``docs``.

    Returns row (a key of doc_id and text), doc_id, size, source_size, target
    and copies. The k-th source in the order of code points, null last, weighs
    ``weights[k % len(weights)]``; the mix holds ``share`` of all words; no
    target is above ``most`` times its source.
    """
    size = F.coalesce(words_in(F.col("text")) if size is None else size, F.lit(0)).cast("long")
    # Rows that are alike are counted on the map side and dealt in pieces.
    sized = stage(
        docs.select(
            F.col("doc_id").cast("string").alias("doc_id"), row_key("doc_id", "text").alias("row"),
            F.col(source).cast("string").alias("source"), size.alias("size"),
        ).groupBy("row", "doc_id", "source", "size").agg(F.count("*").alias("n")),
        "sizes",
    )
    sources = source_plan(sized, weights, share, most)
    known = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    known = known.withColumn("whole", F.floor("ratio").cast("int"))
    known = known.withColumn("mass", (F.col("ratio") - F.col("whole")) * F.col("size"))
    known = known.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(ALIKE).cast("long"))))
    known = known.withColumn("n", F.least(F.lit(ALIKE).cast("long"), F.col("n") - F.col("piece")))
    h = F.xxhash64(F.lit(seed), "row", "piece")
    known = known.withColumn("h", h).withColumn("parent", F.pmod(h, F.col("chunks")).cast("int"))
    columns = ["doc_id", "row", "source", "size", "source_size", "target", "h", "piece", "n", "parent", "whole", "mass"]
    known = known.select(*columns)
    depth, width = 1, sources.agg(F.max("chunks")).first()[0] or 1
    while width > 1:
        depth, width = depth + 1, -(-width // FAN_IN)

    level = known.where("size > 0").groupBy("source", "parent").applyInPandas(_round(seed, 0, depth == 1), known.schema)
    level = decided = stage(level, "mix-0")
    fractional = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    for k in range(1, depth):
        left = level.where(fractional).withColumn("origin", F.col("parent") if k == 1 else F.col("origin"))
        left = left.withColumn("parent", F.floor(F.col("parent") / FAN_IN).cast("int"))
        level = left.groupBy("source", "parent").applyInPandas(_round(seed, k, k == depth - 1), left.schema)
        level = stage(level, f"mix-{k}")
        # A chunk leaves one fractional document, so its number names it.
        settled = level.where(~fractional).select(
            F.col("source").alias("s"), F.col("origin").alias("o"), F.col("mass").alias("m")
        )
        joined = decided.join(
            settled, fractional & F.col("source").eqNullSafe(F.col("s")) & (F.col("parent") == F.col("o")), "left"
        )
        decided = joined.withColumn("mass", F.coalesce("m", "mass")).drop("s", "o", "m")
    idle = known.where("size <= 0").withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("one")
    extra = F.when((F.col("size") > 0) & (F.col("mass") >= F.col("size")), 1).otherwise(0)
    return decided.unionByName(idle).select(
        "row", F.col("doc_id").cast(docs.schema["doc_id"].dataType), "size", "source_size", "target",
        (F.col("whole") + extra).alias("copies"),
    )


def taken(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of each document."""
    out = decide(docs, **parameters)
    return out.select(
        "doc_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("copies") * F.col("size")).otherwise(0).cast("long").alias("taken"),
        "copies",
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Documents without words are not taken. Equal rows are decided one by one
    and their copies added up.
    """
    chosen = decide(docs, **parameters).where("size > 0 AND copies > 0")
    totals = stage(chosen.groupBy("row").agg(F.sum("copies").alias("copies")), "copies")
    one = Window.partitionBy("row").orderBy("row")

    def first_with(wanted: DataFrame) -> DataFrame:
        rows = docs.select(packed(docs), row_key("doc_id", "text").alias("row"))
        return rows.withColumn("n", F.row_number().over(one)).where("n = 1").join(wanted, "row")

    few = first_with(totals.where(F.col("copies") <= MANY)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    out, many = unpacked(few, docs), totals.where(F.col("copies") > MANY)
    if many.isEmpty():
        return out
    # A row taken very often is written by many tasks.
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(MANY).cast("long")))
    spread = first_with(many).withColumn("start", start).repartition("row", "start")
    left = F.least(F.lit(MANY).cast("long"), F.col("copies") - F.col("start"))
    again = spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return out.unionByName(unpacked(again, docs))
