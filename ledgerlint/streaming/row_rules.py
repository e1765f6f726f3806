"""The cleaning rules that look at one line at a time, for streaming input.

Duplicates, credit-note repair, caps and outliers depend on other lines and
belong to the batch run.

A run takes what has arrived in a folder since the run before, in batches of a
bounded number of files, and ends. Which files are done is kept in the checkpoint;
the sink's own log lists the files of finished batches, so a run that was stopped in
the middle is taken up again without losing or repeating a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlint.operators import cleaning as c
from ledgerlint.operators.anomalies import add_anomaly_flags
from ledgerlint.sources.schema import LINE_SCHEMA, typed_lines

FILES_PER_BATCH = 1000


def apply_row_rules(lines: DataFrame) -> DataFrame:
    """Technical lines and unusable prices removed, derived columns added."""
    kept = c.drop_zero_price(c.drop_extreme_price(c.drop_technical(lines)))
    return c.add_is_cancelled(c.add_country_bucket(c.add_basket_value(kept)))


def flag_lines(lines: DataFrame) -> DataFrame:
    return add_anomaly_flags(lines)


def arriving_lines(
    spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH, schema: T.StructType = LINE_SCHEMA
) -> DataFrame:
    """The Parquet files of a folder as a stream of typed lines, oldest first."""
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return typed_lines(read.parquet(folder))


def start(
    lines: DataFrame, rules: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str
) -> StreamingQuery:
    """Apply ``rules`` to all that has arrived, and append it to a Parquet sink."""
    out = rules(lines).writeStream.format("parquet").outputMode("append")
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)


def run(
    spark: SparkSession,
    folder: str,
    sink: str,
    checkpoint: str,
    rules: Callable[[DataFrame], DataFrame] = apply_row_rules,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Process what has arrived since the last run, and return the whole sink."""
    query = start(arriving_lines(spark, folder, files_per_batch), rules, sink, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(sink)
