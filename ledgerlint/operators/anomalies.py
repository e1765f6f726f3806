"""Technical anomaly flags, their counts and examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.functions.columns import order_key, pct
from ledgerlint.functions.predicates import anomaly_flags
from ledgerlint.operators.profiling import counted

DISPLAY = ("invoice", "stockcode", "description", "quantity", "price", "customer_id")


def add_anomaly_flags(lines: DataFrame) -> DataFrame:
    return lines.withColumns(anomaly_flags())


def anomaly_report(counts: DataFrame) -> DataFrame:
    total = counts.agg(
        F.lit("total").alias("flag"),
        F.sum("row_count").alias("row_count"),
        F.max("total_count").alias("total_count"),
    )
    return counts.unionByName(total).select(
        "flag",
        "row_count",
        pct(F.col("row_count"), F.col("total_count"), 4).alias("row_pct"),
    )


def anomaly_summary(lines: DataFrame) -> DataFrame:
    """Per flag: lines and share; the total counts a line once per flag."""
    return anomaly_report(counted(lines, "flag", anomaly_flags()))


def anomaly_examples(lines: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` lines of every flag.

    The rank filter lets Spark keep ``k`` rows per flag and task before the
    shuffle, so a flag that covers much of the table stays cheap.
    """
    names = [F.when(flag, F.lit(name)) for name, flag in anomaly_flags().items()]
    raised = F.filter(F.array(*names), lambda name: name.isNotNull())
    first = Window.partitionBy("flag").orderBy(*order_key(lines.columns))
    return (
        lines.withColumn("flag", F.explode(raised))
        .withColumn("example_no", F.row_number().over(first))
        .where(F.col("example_no") <= k)
        .select("flag", "example_no", *DISPLAY)
    )
