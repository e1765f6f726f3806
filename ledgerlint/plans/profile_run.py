"""All profiling reports of one transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.functions.predicates import anomaly_flags
from ledgerlint.operators import anomalies, baskets, distribution, normality, profiling
from ledgerlint.sources.schema import typed_lines
from ledgerlint.sources.staging import stage
from ledgerlint.sources.tables import load_metadata, write_report


def _counts_in_one_scan(lines: DataFrame) -> dict[str, DataFrame]:
    """The three reports that only count rows, from a single aggregate."""
    groups = {
        "column_name": profiling.null_conditions(lines),
        "metric": profiling.sanity_conditions(),
        "flag": anomaly_flags(),
    }
    conditions = {
        f"{label}/{name}": condition
        for label, named in groups.items()
        for name, condition in named.items()
    }
    counts = stage(profiling.counted(lines, "item", conditions), "counts")

    def part(label: str) -> DataFrame:
        name = F.substring_index("item", "/", -1).alias(label)
        chosen = counts.where(F.col("item").startswith(f"{label}/"))
        return chosen.select(name, "row_count", "total_count")

    return {
        "null_counts": profiling.null_report(part("column_name")),
        "sanity_metrics": profiling.sanity_report(part("metric")),
        "anomaly_summary": anomalies.anomaly_report(part("flag")),
    }


def run_profile(lines: DataFrame, examples: bool = True) -> dict[str, DataFrame]:
    """Report name to report table.

    ``lines`` should be a stored table: each report scans the columns it
    needs. Row counts come from one scan; invoice-level data are derived once.
    """
    lines = typed_lines(lines)
    values = distribution.distribution_values(lines)
    basket_table = stage(baskets.basket_values(lines), "baskets")
    reports = {
        **_counts_in_one_scan(lines),
        "load_metadata": load_metadata(lines),
        "schema_overview": profiling.schema_overview(lines),
        "unique_counts": profiling.unique_counts(lines),
        "duplicate_rows": profiling.duplicate_rows(lines),
        "date_coverage": profiling.date_coverage(lines),
        "top_countries": profiling.top_countries(lines),
        "histogram": distribution.histogram(values),
        "histogram_log10": distribution.histogram_log10(values),
        "boxplot_stats": distribution.boxplot_stats(values),
        "qq_points": distribution.qq_points(values),
        "normality_tests": normality.normality_tests(lines),
        "basket_stats": baskets.basket_stats(basket_table),
        "top_baskets": baskets.top_baskets(basket_table),
        "cap_impact": baskets.cap_impact(basket_table),
    }
    if examples:
        reports["anomaly_examples"] = anomalies.anomaly_examples(lines)
    return reports


def save_profile(reports: dict[str, DataFrame], folder: str, mode: str = "error") -> None:
    for name, report in reports.items():
        write_report(report, f"{folder}/{name}", mode)
