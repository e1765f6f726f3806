"""The whole cleaning run: thirteen steps, audit tables and sinks.

Lines are shuffled twice, once to find exact duplicates and once to collapse
pairs. The distinct lines are stored in between, so that the files of one shuffle
are gone when the next begins, and removed when the labelled result is stored. Every
later pass reads the columns it needs from there. The credit-note repair joins only
negative lines and stores those it keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.operators import cleaning as c
from ledgerlint.operators.checks import enforce, final_assertions
from ledgerlint.operators.forest import remove_outliers
from ledgerlint.operators.waterfall import (
    AUDIT,
    LABEL,
    cleaning_summary,
    distinct_lines,
    label_distinct,
    loss_totals,
    waterfall,
)
from ledgerlint.sources.schema import typed_lines
from ledgerlint.sources.staging import discard, stage
from ledgerlint.sources.tables import write_lines, write_report


@dataclass(frozen=True)
class CleaningRun:
    """The cleaned lines and the tables that account for them."""

    cleaned: DataFrame
    caps: DataFrame
    waterfall: DataFrame
    summary: DataFrame
    assertions: DataFrame


def run_cleaning(lines: DataFrame, config: CleaningConfig) -> CleaningRun:
    """Clean ``lines``; every frame of the result is lazy over stored tables."""
    distinct = stage(distinct_lines(typed_lines(lines), config), "distinct")
    labelled = stage(label_distinct(distinct), "labelled")
    discard(distinct)
    alive = labelled.where(F.col(LABEL).isNull()).drop(*AUDIT)
    kept = c.handle_missing_customer(c.resolve_negative_sales(alive), config)
    valued = c.add_basket_value(kept)

    caps = c.cap_thresholds(valued, config)
    cap_table = c.capped_counts(valued, caps)
    capped = c.add_is_cancelled(c.add_country_bucket(c.apply_caps(valued, caps)))

    removed = 0
    cleaned = capped
    if config.isolation_contam:
        cleaned = remove_outliers(capped, config)
        removed = valued.count() - cleaned.count()

    totals = loss_totals(labelled, config)
    return CleaningRun(
        cleaned=cleaned,
        caps=cap_table,
        waterfall=waterfall(totals, removed),
        summary=cleaning_summary(totals, cap_table, config, len(cleaned.columns), removed),
        assertions=final_assertions(cleaned, config),
    )


def save_run(run: CleaningRun, folder: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write all results. Nothing is written when an assertion fails."""
    enforce(run.assertions)
    write_lines(run.cleaned, f"{folder}/orders_clean", fmt, mode)
    write_report(run.waterfall.orderBy("step_no"), f"{folder}/row_loss_waterfall", mode)
    write_report(run.caps, f"{folder}/cap_thresholds", mode)
    write_report(run.summary, f"{folder}/cleaning_summary", mode)
