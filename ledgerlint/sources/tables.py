"""Reading, combining and writing transaction tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlint.functions.columns import truncate_ntz
from ledgerlint.sources.schema import LINE_SCHEMA, RAW_COLUMNS, typed_lines

#: Rows that a task which widens, sorts and combines them should hold.
ROWS_PER_TASK = 400_000


def read_lines(spark: SparkSession, path: str, schema: T.StructType = LINE_SCHEMA) -> DataFrame:
    """Parquet scan of a combined table with a fixed schema.

    Use ``RAW_SCHEMA`` for a table that still has the original header names.
    """
    return typed_lines(spark.read.schema(schema).parquet(path))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Share a scan with fewer splits than cores among all cores.

    A small file, or one with a single row group, is read by one task, which
    would then also do all work up to the next shuffle. Scans with enough
    splits, as on any large table, are returned unchanged. ``keys`` should
    identify a row, so that no key is hot.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)


def dealt(scan: DataFrame, *keys: str) -> DataFrame:
    """Share a scan of more than ``ROWS_PER_TASK`` rows a core among more tasks.

    Tasks are otherwise sized by bytes of a shuffle, and a task that widens its rows,
    sorts and combines them holds many times those. ``keys`` are those of the next join,
    so that nothing is exchanged once more. Smaller scans are returned unchanged.
    """
    parts = -(-scan.count() // ROWS_PER_TASK)
    if parts <= scan.sparkSession.sparkContext.defaultParallelism:
        return scan
    return scan.repartition(parts, *keys)


def read_year_csv(spark: SparkSession, path: str) -> DataFrame:
    """One yearly CSV with the original header; every field arrives as text."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
    return spark.read.schema(text).csv(path, header=True)


def combine_years(years: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of yearly frames, aligned by name, tagged with their label."""
    tagged = [
        typed_lines(df).withColumn("source_year", F.lit(label))
        for label, df in years.items()
    ]
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged
    )


def load_metadata(lines: DataFrame) -> DataFrame:
    """Rows per source year and, with a null year, rows in total."""
    return (
        lines.rollup("source_year")
        .agg(
            F.grouping("source_year").cast("int").alias("is_total"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read the combined table, writing it first when there is none.

    A folder without the mark of a finished write is what a failed one leaves
    behind; it is replaced. A finished table without rows is kept.
    """
    if _finished(spark, path):
        return read_lines(spark, path)
    write_lines(build(), path, mode="overwrite")
    return read_lines(spark, path)


def _finished(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    mark = context._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(context._jsc.hadoopConfiguration()).exists(mark)


def write_lines(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write a line table, timestamps truncated to milliseconds."""
    stamps = {
        f.name: truncate_ntz(f.name, "MILLISECOND")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    out = df.withColumns(stamps) if stamps else df
    if fmt == "parquet":
        out.write.mode(mode).option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        out.write.mode(mode).option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def write_report(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a small report table as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)
