"""Exact quantiles by ranks over range partitions.

The built-in exact percentile keeps a map of every distinct value in a single
buffer. Here values are combined on the map side, so a frequent value is one row
per task, and the distinct values are dealt into range partitions. One row for each
partition tells which of them holds a wanted rank; only those are read again, for the
rows whose running sums hold it. No task sees more than a range of values, at
any size, and several columns share the passes.

Linear interpolation between the two neighbouring order statistics.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.functions.columns import finite
from ledgerlint.sources.staging import stage

KEY = ("variable", "value")

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition with the weight of their variable up to and with them."""
    last, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names = pc.dictionary_encode(batch.column("variable"))
        codes = names.indices.to_numpy()
        weights = batch.column("weight").to_numpy()
        starts = np.r_[True, codes[1:] != codes[:-1]]
        sums = np.cumsum(weights)
        # What was summed up before each variable's first row.
        before = np.maximum.accumulate(np.where(starts, np.arange(len(codes)), 0))
        running = sums - (sums - weights)[before]
        if batch.column("variable")[0].as_py() == last:
            running[before == 0] += total
        last, total = batch.column("variable")[-1].as_py(), int(running[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(running, pa.int64())], names=[*batch.schema.names, "running"]
        )


def ranged(values: DataFrame, parts: int | None = None) -> DataFrame:
    """``values`` (variable, value, weight) stored by ranges: ``part`` is the number of the range,
    ``running`` the weight of the variable in it up to and with the value.

    ``parts`` fixes the number of ranges; by default Spark sizes them.
    """
    dealt = values.select(*KEY, F.col("weight").cast("long").alias("weight")).repartitionByRange(
        *([] if parts is None else [parts]), *KEY
    )
    ordered = dealt.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*KEY)
    summed = "variable string, value double, weight long, part int, running long"
    return stage(ordered.mapInArrow(_accumulated, summed), "parts")


def value_ranks(values: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct ``values`` with the first and last rank of each value in its variable.

    A running sum within each part is shifted by the weight of the parts before it,
    of which there is one row each.
    """
    stored = ranged(values, parts)
    sums = stored.groupBy("variable", "part").agg(F.max("running").alias("inside"))
    before = Window.partitionBy("variable").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("variable", "part", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("offset"))
    return (
        stored.join(offsets, ["variable", "part"])
        .withColumn("last_rank", F.col("offset") + F.col("running"))
        .withColumn("first_rank", F.col("last_rank") - F.col("weight") + 1)
        .select(*KEY, "weight", "first_rank", "last_rank")
    )


def _values_at(stored: DataFrame, wanted: Mapping[str, Sequence[int]], sums: Sequence[tuple]) -> dict:
    """The value at each wanted rank (from 0) of each variable, as {(variable, rank): value}.

    ``sums`` are (variable, part, weight), in the order of the parts.
    """
    spots, below = [], dict.fromkeys(wanted, 0)
    for variable, part, weight in sums:
        start = below[variable]
        spots += [(variable, part, r - start, r) for r in wanted[variable] if start <= r < start + weight]
        below[variable] = start + weight
    # Two for each probability at most; the scan skips all files of other ranges.
    found = F.lit(False)
    for variable, part, inside, _ in spots:
        after = F.col("running")
        held = (after > inside) & (after - F.col("weight") <= inside)
        found = found | ((F.col("part") == part) & (F.col("variable") == variable) & held)
    rows = stored.where(found).collect()
    held_by = {}
    for variable, part, inside, rank in spots:
        for r in rows:
            if (r["variable"], r["part"]) == (variable, part) and 0 <= r["running"] - inside - 1 < r["weight"]:
                held_by[variable, rank] = r["value"]
    return held_by


def distinct_quantiles(
    values: DataFrame, probs: Mapping[str, Sequence[float]], parts: int | None = None
) -> dict[str, list[float | None]]:
    """Quantiles of each named variable at its own probabilities; all None for one without values.

    ``values`` has variable, value and weight, one row for each distinct value, and
    weights above 0.
    """
    stored = ranged(values.where(F.col("variable").isin(list(probs))), parts)
    per_part = stored.groupBy("variable", "part").agg(F.max("running").alias("w")).collect()
    sums = sorted((r["variable"], r["part"], r["w"]) for r in per_part)
    totals = dict.fromkeys(probs, 0)
    for variable, _, weight in sums:
        totals[variable] += weight

    spots = {}
    for variable, total in totals.items():
        spots[variable] = []
        for p in probs[variable] if total else ():
            position = p * (total - 1)
            low = min(math.floor(position), total - 1)
            spots[variable].append((low, min(low + 1, total - 1), position - low))
    wanted = {v: sorted({r for low, high, _ in s for r in (low, high)}) for v, s in spots.items()}
    found = _values_at(stored, wanted, sums) if sums else {}

    def at(variable: str, low: int, high: int, part: float) -> float:
        first = found[variable, low]
        return first if not part else first + (found[variable, high] - first) * part

    return {
        v: [at(v, *spot) for spot in spots[v]] if totals[v] else [None] * len(probs[v]) for v in probs
    }


def column_quantiles(
    columns: Mapping[str, tuple[DataFrame, str]],
    probs: Mapping[str, Sequence[float]],
    weight: str | None = None,
    parts: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of several columns at once: a frame and a column of it by name.

    Null, NaN and infinities are ignored. ``weight`` names an integer column of the
    frames saying how often each value counts. Frames are read once.
    """
    long = None
    for name, (df, column) in columns.items():
        times = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
        one = df.select(
            F.lit(name).alias("variable"), finite(F.col(column).cast("double")).alias("value"), times.alias("weight")
        )
        long = one if long is None else long.unionByName(one)
    usable = long.where(F.col("value").isNotNull() & (F.col("weight") > 0))
    # Adding 0.0 makes -0.0 equal to it.
    distinct = usable.groupBy("variable", (F.col("value") + F.lit(0.0)).alias("value")).agg(
        F.sum("weight").alias("weight")
    )
    return distinct_quantiles(distinct, probs, parts)


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], weight: str | None = None, parts: int | None = None
) -> list[float | None]:
    """Quantiles of ``column`` at ``probs``; all None when there is no value."""
    return column_quantiles({column: (df, column)}, {column: list(probs)}, weight, parts)[column]
