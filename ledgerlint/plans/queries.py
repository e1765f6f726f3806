"""Registered queries: every operator over the fixture view of given tables.

Operators that read their input more than once get a stored copy of the view.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.functions.columns import truncate_ntz
from ledgerlint.functions.predicates import is_credit
from ledgerlint.operators import anomalies, baskets, checks, cleaning, distribution
from ledgerlint.operators import forest, monitoring, normality, profiling
from ledgerlint.operators.waterfall import label_lines, loss_totals, waterfall
from ledgerlint.plans.cleaning_run import run_cleaning
from ledgerlint.sources import fixture
from ledgerlint.sources.manifest import file_manifest
from ledgerlint.sources.schema import LINE_COLUMNS, RAW_SCHEMA
from ledgerlint.sources.staging import stage, staging_dir
from ledgerlint.sources.tables import combine_years, load_metadata, read_lines, read_year_csv, write_lines
from ledgerlint.sources.versions import read_or_rebuild
from ledgerlint.streaming import row_rules

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = CleaningConfig(
    isolation_contam=0.0, date_min=fixture.DATE_MIN, date_max=fixture.DATE_MAX
)
IMPUTE = CleaningConfig(
    drop_missing_id=False,
    isolation_contam=0.0,
    date_min=fixture.DATE_MIN,
    date_max=fixture.DATE_MAX,
)
WITH_FOREST = CleaningConfig(date_min=fixture.DATE_MIN, date_max=fixture.DATE_MAX)
SALT = "ledger"
# Files in which the lines of some years arrive.
STREAM_FILES = 8
# So many ranges that those of small tables hold a few values each, as large tables have.
MANY_PARTS = 64


def _on_view(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A single-pass operator over the view."""
    return lambda spark, sf_dir: operator(fixture.transactions(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    view = fixture.transactions(spark, sf_dir)
    return stage(view.select(*columns) if columns else view, "lines")


def _on_stored(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A multi-pass operator over the stored view, limited to ``columns``."""
    return lambda spark, sf_dir: operator(_stored(spark, sf_dir, *columns))


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Sums, means and quantiles differ in the last digit between engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _yearly(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    view = fixture.transactions(spark, sf_dir)
    return {
        year: view.where(F.col("source_year") == year).drop("source_year")
        for year in (fixture.FIRST_YEARS, fixture.LAST_YEARS)
    }


def _combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_years(_yearly(spark, sf_dir))


def _load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = _yearly(spark, sf_dir)
    first, last = years.values()
    table = checks.schema_match(first, last, "all")
    for year, lines in years.items():
        table = table.unionByName(checks.load_checks(lines, year))
    return table


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_manifest(spark, f"{sf_dir}/*.parquet")


def _round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written under the original header, read back and compared row by row."""
    view = stage(fixture.transactions(spark, sf_dir), "lines")
    # The original table keeps customer numbers as floats.
    raw = view.withColumn("customer_id", F.col("customer_id").cast("double"))
    header = dict(zip(LINE_COLUMNS, RAW_SCHEMA.fieldNames()))
    path = f"{staging_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    write_lines(raw.select(*(F.col(c).alias(header.get(c, c)) for c in raw.columns)), path)
    again = read_lines(spark, path, RAW_SCHEMA)
    stamped = view.withColumn("invoicedate", truncate_ntz("invoicedate", "MILLISECOND"))
    sides = stamped.withColumn("written", F.lit(1)).unionByName(again.withColumn("written", F.lit(0)))
    per_line = sides.groupBy(*view.columns).agg(
        F.sum("written").alias("written"), F.sum(1 - F.col("written")).alias("read")
    )
    return per_line.agg(
        F.sum("written").alias("rows_written"), F.sum("read").alias("rows_read"),
        F.sum(F.abs(F.col("written") - F.col("read"))).alias("differing"),
    )


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as CSV by year, read back and counted."""
    path = f"{staging_dir(spark)}/csv-{uuid.uuid4().hex}"
    view = fixture.transactions(spark, sf_dir)
    header = dict(zip(LINE_COLUMNS, RAW_SCHEMA.fieldNames()))
    raw = view.drop("source_year").select(*(F.col(c).alias(header.get(c, c)) for c in LINE_COLUMNS[:-1]))
    write_lines(raw, path, fmt="csv")
    again = combine_years({"all": read_year_csv(spark, path)})
    # Whole numbers add up alike in any order.
    price = F.sum(F.round(F.col("price") * 1000).cast("long")).alias("price_thousandths")
    return again.agg(
        F.count("*").alias("rows_read"), F.sum("quantity").alias("quantity"), price,
        F.count("customer_id").alias("customers"), F.count("description").alias("descriptions"),
        F.min("invoicedate").cast("string").alias("first_date"),
    )


def _reuse_or_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is done with a stored table as its source files stay, grow and change."""
    base = f"{staging_dir(spark)}/reuse-{uuid.uuid4().hex}"
    incoming, table = f"{base}/incoming", f"{base}/combined"
    view = fixture.transactions(spark, sf_dir)
    years = {year: view.where(F.col("source_year") == year) for year in (fixture.FIRST_YEARS, fixture.LAST_YEARS)}
    steps = []

    def visit(step: str) -> None:
        lines, action = read_or_rebuild(spark, table, f"{incoming}/*", lambda: spark.read.parquet(f"{incoming}/*"))
        steps.append((step, action, lines.count()))

    write_lines(years[fixture.FIRST_YEARS], f"{incoming}/first")
    visit("1 first years")
    visit("2 no change")
    write_lines(years[fixture.LAST_YEARS], f"{incoming}/last")
    visit("3 last years added")
    write_lines(years[fixture.LAST_YEARS].where("quantity > 0"), f"{incoming}/last", mode="overwrite")
    visit("4 last years changed")
    return spark.createDataFrame(steps, "step string, action string, row_count long")


def _streamed(rules: Callable[[DataFrame], DataFrame]) -> Query:
    """Rules over lines that arrive in files, processed in two runs of several batches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = f"{staging_dir(spark)}/stream-{uuid.uuid4().hex}"
        incoming, sink, checkpoint = (f"{base}/{name}" for name in ("incoming", "sink", "checkpoint"))
        view = fixture.transactions(spark, sf_dir)
        for year in (fixture.FIRST_YEARS, fixture.LAST_YEARS):
            arrived = view.where(F.col("source_year") == year).repartition(STREAM_FILES, "invoice", "stockcode")
            arrived.write.mode("append").parquet(incoming)
            out = row_rules.run(spark, incoming, sink, checkpoint, rules, files_per_batch=STREAM_FILES // 2)
        return out

    return query


def _row_rules_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_streamed(row_rules.apply_row_rules)(spark, sf_dir), "basket_value")


def _on_traps(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A single-pass operator over the view with null, infinite and negative values."""
    return lambda spark, sf_dir: operator(fixture.transactions_with_traps(spark, sf_dir))


def _finite_values(lines: DataFrame) -> DataFrame:
    """What the distributions keep of each variable."""
    values = distribution.distribution_values(stage(lines, "lines"))
    weighted = F.col("value") * F.col("weight")
    return rounded(
        values.groupBy("variable").agg(
            F.sum("weight").alias("row_count"), F.min("value").alias("low"), F.max("value").alias("high"),
            (F.sum(weighted) / F.sum("weight")).alias("mean"),
        ),
        "low", "high", "mean",
    )


def _cap_thresholds(valued: DataFrame, parts: int | None = None) -> DataFrame:
    caps = cleaning.cap_thresholds(valued, CONFIG, parts)
    return rounded(cleaning.capped_counts(valued, caps), "price_cap", "basket_cap")


def _apply_caps(valued: DataFrame) -> DataFrame:
    capped = cleaning.apply_caps(valued, cleaning.cap_thresholds(valued, CONFIG))
    return rounded(capped, "price", "basket_value")


def _on_valued(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A step after basket values, over the stored view with basket values."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = fixture.transactions(spark, sf_dir)
        return operator(stage(cleaning.add_basket_value(view), "valued"))

    return query


def _waterfall(lines: DataFrame) -> DataFrame:
    return waterfall(loss_totals(label_lines(lines, CONFIG), CONFIG))


def _clean(config: CleaningConfig) -> Query:
    return _on_view(
        lambda lines: rounded(run_cleaning(lines, config).cleaned, "price", "basket_value")
    )


def _on_baskets(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """An operator over the stored basket values of the view."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = fixture.transactions(spark, sf_dir)
        return operator(stage(baskets.basket_values(view), "baskets"))

    return query


def _on_values(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """An operator over the stored distribution values of the view."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = _stored(spark, sf_dir, "invoice", "quantity", "price")
        return operator(distribution.distribution_values(lines))

    return query


def _on_basket_distribution(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = fixture.transactions(spark, sf_dir)
        return operator(distribution.basket_distribution(baskets.basket_values(view)))

    return query


def _histogram(values: DataFrame) -> DataFrame:
    return rounded(distribution.histogram(values), "bin_low", "bin_high")


def _histogram_log10(values: DataFrame) -> DataFrame:
    return rounded(distribution.histogram_log10(values), "bin_low", "bin_high")


def _qq_points(values: DataFrame) -> DataFrame:
    points = rounded(distribution.qq_points(values), "slope", "intercept")
    points = rounded(rounded(points, "theoretical", "r", digits=6), "sample", digits=7)
    return points.withColumn("theoretical", F.col("theoretical") + 0.0)  # no negative zero


def _normality_tests(lines: DataFrame) -> DataFrame:
    return rounded(normality.normality_tests(lines), "p_value", "statistic", digits=6)


def _shapiro_statistics(lines: DataFrame) -> DataFrame:
    return rounded(normality.shapiro_wilk(normality.sample_values(lines)), "statistic", digits=6)


def _forest_counts(valued: DataFrame) -> DataFrame:
    """Credit lines all stay; of the sale lines no more than the share go."""
    kept = forest.remove_outliers(valued, WITH_FOREST)
    credit = F.count_if(is_credit())
    before = valued.agg(credit.alias("credit_lines"), (F.count("*") - credit).alias("sale_lines"))
    after = kept.agg(credit.alias("credit_kept"), (F.count("*") - credit).alias("sale_kept"))
    share = WITH_FOREST.isolation_contam * F.col("sale_lines")
    within = F.col("sale_lines") - F.col("sale_kept") <= share + 1
    # Two tables of one row each.
    both = before.withColumn("one", F.lit(1)).join(after.withColumn("one", F.lit(1)), "one")
    return both.select("credit_lines", "credit_kept", "sale_lines", within.alias("within_share"))


def _boxplot(values: DataFrame, parts: int | None = None) -> DataFrame:
    table = distribution.boxplot_stats(values, parts)
    return rounded(table, "q1", "median", "q3", "whisker_low", "whisker_high")


def _rounded_doubles(operator: Callable[[DataFrame], DataFrame]):
    def run(df: DataFrame) -> DataFrame:
        out = operator(df)
        return rounded(out, *(c for c, t in out.dtypes if t == "double"))

    return run


def _is_expected() -> Column:
    return F.col("source_year") == fixture.FIRST_YEARS


def _psi(lines: DataFrame) -> DataFrame:
    return rounded(monitoring.psi(lines, "price", _is_expected()), "psi", digits=6)


def _psi_buckets(lines: DataFrame) -> DataFrame:
    table = monitoring.psi_buckets(lines, "price", _is_expected())
    return rounded(
        table, "expected_share", "actual_share", "contribution", digits=6
    )


def _threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = labels.withColumn("score", (F.col("doc_id") * 7919 % 1000) / F.lit(1000.0))
    table = monitoring.threshold_metrics(scored, "score", "quality")
    return rounded(table, "threshold", "precision", "recall", "f1", "flag_rate", digits=6)


QUERIES: dict[str, Query] = {
    # sources
    "combine_years": _combine,
    "load_checks": _load_checks,
    "file_manifest": _manifest,
    "load_metadata": _on_view(load_metadata),
    "round_trip": _round_trip,
    "csv_round_trip": _csv_round_trip,
    "reuse_or_build": _reuse_or_build,
    # streams
    "row_rules_stream": _row_rules_stream,
    "anomaly_flags_stream": _streamed(row_rules.flag_lines),
    # null, infinite and negative values
    "drop_technical_traps": _on_traps(cleaning.drop_technical),
    "drop_extreme_price_traps": _on_traps(cleaning.drop_extreme_price),
    "drop_zero_price_traps": _on_traps(cleaning.drop_zero_price),
    "basket_value_traps": _on_traps(lambda lines: rounded(cleaning.add_basket_value(lines), "basket_value")),
    "sanity_metrics_traps": _on_traps(profiling.sanity_metrics),
    "finite_values_traps": _on_traps(_finite_values),
    # cleaning steps
    "exact_dedupe": _on_view(cleaning.drop_exact_duplicates),
    "collapse_lines": _on_view(
        lambda lines: cleaning.collapse_lines(cleaning.drop_exact_duplicates(lines))
    ),
    "drop_technical": _on_view(cleaning.drop_technical),
    "drop_extreme_price": _on_view(cleaning.drop_extreme_price),
    "drop_zero_price": _on_view(cleaning.drop_zero_price),
    "fix_credit_prefix": _on_stored(cleaning.fix_credit_prefix),
    "drop_negative_sales": _on_view(cleaning.drop_negative_sales),
    "drop_missing_customer": _on_view(cleaning.drop_missing_customer),
    "impute_missing_customer": _on_view(cleaning.impute_missing_customer),
    "basket_value": _on_view(
        lambda lines: rounded(cleaning.add_basket_value(lines), "basket_value")
    ),
    "cap_thresholds": _on_valued(_cap_thresholds),
    "cap_thresholds_refined": _on_valued(lambda valued: _cap_thresholds(valued, MANY_PARTS)),
    "apply_caps": _on_valued(_apply_caps),
    "country_bucket": _on_view(cleaning.add_country_bucket),
    "country_bucket_counts": _on_view(cleaning.country_bucket_counts),
    "is_cancelled": _on_view(cleaning.add_is_cancelled),
    "is_cancelled_counts": _on_view(cleaning.is_cancelled_counts),
    "isolation_forest": _on_valued(
        lambda lines: forest.remove_outliers(lines, WITH_FOREST)
    ),
    "isolation_forest_counts": _on_valued(_forest_counts),
    "final_assertions": _on_view(lambda lines: checks.final_assertions(lines, CONFIG)),
    "waterfall": _on_view(_waterfall),
    "cleaning_summary": _on_view(lambda lines: run_cleaning(lines, CONFIG).summary),
    "clean_orders": _clean(CONFIG),
    "clean_orders_imputed": _clean(IMPUTE),
    # All steps, the forest too: what is checked is what a run by default would save.
    "clean_orders_checks": _on_view(lambda lines: run_cleaning(lines, WITH_FOREST).assertions),
    "clean_orders_with_forest": _clean(WITH_FOREST),
    # profiling
    "schema_overview": _on_stored(profiling.schema_overview),
    "null_counts": _on_view(profiling.null_counts),
    "high_null_columns": _on_view(profiling.high_null_columns),
    "unique_counts": _on_view(profiling.unique_counts),
    "sanity_metrics": _on_view(profiling.sanity_metrics),
    "duplicate_rows": _on_view(profiling.duplicate_rows),
    "date_coverage": _on_view(profiling.date_coverage),
    "top_countries": _on_view(profiling.top_countries),
    # anomalies
    "anomaly_flags": _on_view(anomalies.add_anomaly_flags),
    "anomaly_summary": _on_view(anomalies.anomaly_summary),
    "anomaly_examples": _on_view(anomalies.anomaly_examples),
    # distributions
    "invoice_basket_metric": _on_view(
        lambda lines: rounded(
            baskets.invoice_basket_metric(lines), "mean_price", "basket_value", digits=7
        )
    ),
    "lines_with_basket": _on_stored(
        lambda lines: rounded(baskets.lines_with_basket(lines), "basket_value", digits=7)
    ),
    "histogram": _on_values(_histogram),
    "histogram_log10": _on_values(_histogram_log10),
    "boxplot_stats": _on_values(_boxplot),
    "boxplot_stats_refined": _on_values(lambda values: _boxplot(values, MANY_PARTS)),
    "lines_with_basket_hot": _on_stored(
        lambda lines: rounded(baskets.lines_with_basket(lines, hot_rows=6), "basket_value", digits=7)
    ),
    "qq_points": _on_values(_qq_points),
    "normality_tests": _on_stored(
        _normality_tests, "invoice", "stockcode", "quantity", "price"
    ),
    "shapiro_statistics": _on_stored(
        _shapiro_statistics, "invoice", "stockcode", "quantity", "price"
    ),
    # basket outliers
    "basket_rollup": _on_view(_rounded_doubles(baskets.basket_rollup)),
    "basket_percentiles": _on_baskets(_rounded_doubles(baskets.basket_percentiles)),
    "top_baskets": _on_view(
        lambda lines: rounded(
            baskets.top_baskets(baskets.basket_values(lines)), "basket_value"
        )
    ),
    "basket_stats": _on_baskets(_rounded_doubles(baskets.basket_stats)),
    "cap_impact": _on_baskets(_rounded_doubles(baskets.cap_impact)),
    "recommended_cap": _on_baskets(_rounded_doubles(baskets.recommended_cap)),
    "basket_histogram": _on_basket_distribution(_histogram),
    "basket_boxplot": _on_basket_distribution(_boxplot),
    # monitoring
    "psi": _on_stored(_psi, "price", "source_year"),
    "psi_buckets": _on_stored(_psi_buckets, "price", "source_year"),
    "threshold_metrics": _threshold_metrics,
    "pseudonymise": _on_view(lambda lines: monitoring.pseudonymise(lines, SALT)),
    "full_basket_return": _on_stored(
        monitoring.full_basket_return,
        "invoice", "customer_id", "stockcode", "invoicedate", "quantity",
    ),
}
