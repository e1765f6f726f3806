"""Invoice-level basket values and the caps they suggest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import BASKET_PERCENTILES, CAP_LABELS, RECOMMENDED_PERCENTILE
from ledgerlint.functions.columns import finite, first_non_null, order_key, pct
from ledgerlint.operators.joins import attach_group_values
from ledgerlint.operators.quantiles import exact_quantiles
from ledgerlint.sources.staging import stage


def invoice_basket_metric(lines: DataFrame) -> DataFrame:
    """Per invoice: total quantity times mean price, credit notes included."""
    keyed = lines.where(F.col("invoice").isNotNull())
    per_invoice = keyed.groupBy("invoice").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        F.avg("price").alias("mean_price"),
        F.count(F.lit(1)).alias("line_count"),
    )
    value = F.col("total_quantity") * F.col("mean_price")
    return per_invoice.withColumn("basket_value", value)


def lines_with_basket(lines: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Lines with the basket value of their invoice.

    Reads ``lines`` several times: pass a stored table.
    """
    metric = invoice_basket_metric(lines).select("invoice", "basket_value", "line_count")
    return attach_group_values(lines, stage(metric, "metric"), ["invoice"], "line_count", hot_rows)


def basket_rollup(lines: DataFrame) -> DataFrame:
    """Per invoice, over sold lines: value, quantity and first customer data."""
    sold = lines.where((F.col("quantity") > 0) & F.col("invoice").isNotNull())
    order = order_key(lines.columns, exclude=("invoice",))
    return sold.groupBy("invoice").agg(
        F.coalesce(F.sum(F.col("quantity") * F.col("price")), F.lit(0.0)).alias(
            "basket_value"
        ),
        F.sum("quantity").alias("total_quantity"),
        *(first_non_null(c, order) for c in ("customer_id", "country", "invoicedate")),
    )


def basket_values(lines: DataFrame) -> DataFrame:
    """``(invoice, basket_value)`` of the rollup, finite values only."""
    sold = lines.where((F.col("quantity") > 0) & F.col("invoice").isNotNull())
    rolled = sold.groupBy("invoice").agg(
        F.coalesce(F.sum(F.col("quantity") * F.col("price")), F.lit(0.0)).alias("v")
    )
    return rolled.select("invoice", finite(F.col("v")).alias("basket_value")).dropna()


def _thresholds(
    baskets: DataFrame, percentiles: Sequence[float], parts: int | None
) -> list[float | None]:
    probs = [p / 100 for p in percentiles]
    return exact_quantiles(baskets, "basket_value", probs, parts=parts)


def basket_percentiles(
    baskets: DataFrame,
    percentiles: Sequence[float] = BASKET_PERCENTILES,
    parts: int | None = None,
) -> DataFrame:
    """``(percentile, basket_value)``. ``baskets`` is read several times."""
    values = _thresholds(baskets, percentiles, parts)
    return baskets.sparkSession.createDataFrame(
        list(zip(map(float, percentiles), values)),
        "percentile double, basket_value double",
    )


def top_baskets(baskets: DataFrame, k: int = 5) -> DataFrame:
    return baskets.orderBy(F.desc("basket_value"), "invoice").limit(k)


def basket_stats(baskets: DataFrame, parts: int | None = None) -> DataFrame:
    """One row: count, mean, median, sample deviation, coefficient of variation."""
    (median,) = exact_quantiles(
        baskets, "basket_value", [0.5], parts=parts
    )
    mean, std = F.avg("basket_value"), F.stddev_samp("basket_value")
    return baskets.agg(
        F.count("basket_value").alias("basket_count"),
        mean.alias("mean_value"),
        F.lit(median).cast("double").alias("median_value"),
        std.alias("std_value"),
        F.try_divide(std, mean).alias("coefficient_of_variation"),
    )


def cap_impact(
    baskets: DataFrame,
    percentiles: Sequence[float] = BASKET_PERCENTILES,
    parts: int | None = None,
) -> DataFrame:
    """Per candidate cap: baskets strictly above it, all counted in one scan."""
    caps = _thresholds(baskets, percentiles, parts)
    above = [
        F.count_if(F.col("basket_value") > F.lit(cap).cast("double")).alias(f"n{i}")
        for i, cap in enumerate(caps)
    ]
    row = baskets.agg(F.count("basket_value").alias("total"), *above)
    entries = [
        F.struct(
            F.lit(float(percentile)).alias("percentile"),
            F.lit(CAP_LABELS.get(percentile)).cast("string").alias("approach"),
            F.lit(cap).cast("double").alias("threshold"),
            F.col(f"n{i}").alias("affected_count"),
            pct(F.col(f"n{i}"), F.col("total")).alias("affected_pct"),
        )
        for i, (percentile, cap) in enumerate(zip(percentiles, caps))
    ]
    return row.select(F.inline(F.array(*entries)))


def recommended_cap(baskets: DataFrame, parts: int | None = None) -> DataFrame:
    impact = cap_impact(baskets, parts=parts)
    return impact.where(F.col("percentile") == RECOMMENDED_PERCENTILE)
