"""Row-loss accounting without a count per step.

Every collapsed line gets the label of the first rule that removes it. The
credit-note repair depends on whole invoices, but its effect on row *counts*
follows from a few counters per invoice, so the waterfall is one plan: distinct
rows, pairs, invoices, one total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import WATERFALL_STEPS, CleaningConfig
from ledgerlint.functions import predicates as p
from ledgerlint.functions.columns import pct
from ledgerlint.operators.cleaning import COPIES, PAIR, _collapse, _distinct_with_copies

N_RAW, N_DISTINCT, LABEL = "n_raw", "n_distinct", "drop_step"
AUDIT = (N_RAW, N_DISTINCT, LABEL)


def label_lines(lines: DataFrame, config: CleaningConfig) -> DataFrame:
    """Collapsed lines with ``n_raw``, ``n_distinct`` and ``drop_step``.

    ``drop_step`` names the first of the rules up to zero price that removes
    the line, or is null. Lines without a full key stay, labelled as lost to
    the collapse, so that ``n_raw`` adds up to the input.
    """
    return label_distinct(distinct_lines(lines, config))


def distinct_lines(lines: DataFrame, config: CleaningConfig) -> DataFrame:
    """The distinct lines and how often each occurs."""
    return _distinct_with_copies(lines, config.dedupe_exclude)


def label_distinct(distinct: DataFrame) -> DataFrame:
    """``label_lines`` of lines as ``distinct_lines`` returns them."""
    collapsed = _collapse(
        distinct.withColumnRenamed(COPIES, N_RAW).withColumn(N_DISTINCT, F.lit(1)),
        audit={N_RAW: F.sum(N_RAW), N_DISTINCT: F.sum(N_DISTINCT)},
    )
    no_key = F.lit(False)
    for key in PAIR:
        no_key = no_key | F.col(key).isNull()
    return collapsed.withColumn(
        LABEL,
        F.when(no_key, "collapse_duplicates")
        .when(p.is_technical(), "drop_technical")
        .when(~p.is_acceptable_price(), "drop_extreme_prices")
        .when(p.is_zero_price_sale(), "drop_zero_price"),
    )


def loss_totals(labelled: DataFrame, config: CleaningConfig) -> DataFrame:
    """One row: rows removed by each step, and repaired invoices."""
    alive = F.col(LABEL).isNull()
    negative = p.is_negative()
    missing = F.col("customer_id").isNull()
    per_invoice = (
        labelled.withColumn("sale", F.when(alive & ~p.is_credit(), F.col("invoice")))
        .groupBy(LABEL, "sale")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(N_RAW).alias(N_RAW),
            F.sum(N_DISTINCT).alias(N_DISTINCT),
            F.count_if(negative).alias("n_negative"),
            F.count_if(missing).alias("n_missing"),
            F.count_if(missing & negative).alias("n_missing_negative"),
        )
    )
    is_sale = F.col("sale").isNotNull()
    repaired = is_sale & (F.col("n_negative") == F.col("n"))
    mixed = is_sale & ~repaired

    def total(condition: Column, what: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(what))), F.lit(0))

    def labelled_as(step: str) -> Column:
        return p.holds(F.col(LABEL) == step)

    everything = F.lit(True)
    lost_keys = labelled_as("collapse_duplicates")
    exact = total(everything, N_RAW) - total(everything, N_DISTINCT)
    collapsed = total(everything, N_DISTINCT) - total(~lost_keys, "n")
    missing_id = F.lit(0)
    if config.drop_missing_id:
        missing_id = total(F.col(LABEL).isNull(), "n_missing") - total(
            mixed, "n_missing_negative"
        )
    return per_invoice.agg(
        total(everything, N_RAW).alias("initial"),
        exact.alias("exact_duplicates"),
        collapsed.alias("collapsed_lines"),
        *(
            total(labelled_as(step), "n").alias(step)
            for step in ("drop_technical", "drop_extreme_prices", "drop_zero_price")
        ),
        F.count_if(repaired).alias("invoices_repaired"),
        total(mixed, "n_negative").alias("drop_negative_non_credit"),
        missing_id.cast("long").alias("handle_missing_id"),
    )


def waterfall(totals: DataFrame, outliers_removed: int = 0) -> DataFrame:
    """``(step_no, step, rows_remaining, rows_removed)``, eight rows."""
    removed = {
        "initial": F.lit(0),
        "collapse_duplicates": F.col("exact_duplicates") + F.col("collapsed_lines"),
        "isolation_forest": F.lit(outliers_removed),
    }
    remaining = F.col("initial")
    entries = []
    for number, step in enumerate(WATERFALL_STEPS):
        lost = removed.get(step, F.col(step)).cast("long")
        remaining = remaining - lost
        entries.append(
            F.struct(
                F.lit(number).alias("step_no"),
                F.lit(step).alias("step"),
                remaining.cast("long").alias("rows_remaining"),
                lost.alias("rows_removed"),
            )
        )
    return totals.select(F.inline(F.array(*entries)))


def _long(row: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
        for name, value in metrics.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def cleaning_summary(
    totals: DataFrame,
    caps: DataFrame,
    config: CleaningConfig,
    column_count: int,
    outliers_removed: int = 0,
) -> DataFrame:
    """Long table ``(metric, value)`` of the whole run.

    ``totals`` and ``caps`` have one row each.
    """
    steps = (
        "exact_duplicates", "collapsed_lines", "drop_technical",
        "drop_extreme_prices", "drop_zero_price", "drop_negative_non_credit",
        "handle_missing_id",
    )
    final = F.col("initial") - F.lit(outliers_removed)
    for step in steps:
        final = final - F.col(step)
    of_rows = _long(
        totals,
        {
            "initial_rows": F.col("initial"),
            "final_rows": final,
            "retention_pct": pct(final, F.col("initial"), 1),
            **{step: F.col(step) for step in steps},
            "invoices_repaired": F.col("invoices_repaired"),
            "isolation_forest": F.lit(outliers_removed),
            "column_count": F.lit(column_count),
            "price_cap_q": F.lit(config.price_cap_q),
            "basket_cap_q": F.lit(config.basket_cap_q),
            "isolation_contam": F.lit(config.isolation_contam),
        },
    )
    of_caps = _long(
        caps,
        {
            "price_cap": F.round("price_cap", 4),
            "basket_cap": F.round("basket_cap", 4),
            "price_capped_count": F.col("price_capped_count"),
            "basket_capped_count": F.col("basket_capped_count"),
        },
    )
    return of_rows.unionByName(of_caps)
