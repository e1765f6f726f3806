"""Load circuit breakers and final assertions, as result tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import MAX_YEAR, MIN_LOAD_ROWS, MIN_YEAR, CleaningConfig
from ledgerlint.functions import predicates as p

REQUIRED = ("invoice", "stockcode", "quantity", "invoicedate")


def _table(df: DataFrame, source: str, checks: Sequence[tuple]) -> DataFrame:
    """Rows ``(source, check, severity, passed, observed)`` from one-row ``df``."""
    entries = [
        F.struct(
            F.lit(source).alias("source"),
            F.lit(name).alias("check"),
            F.lit(severity).alias("severity"),
            p.holds(passed).alias("passed"),
            observed.cast("string").alias("observed"),
        )
        for name, severity, passed, observed in checks
    ]
    return df.select(F.inline(F.array(*entries)))


def load_checks(lines: DataFrame, source: str) -> DataFrame:
    """Circuit breakers on one loaded table, in a single aggregate.

    Missing columns are reported alone: nothing else can be checked then.
    """
    missing = [c for c in REQUIRED if c not in lines.columns]
    absent = F.lit(", ".join(missing))
    if missing:
        one = lines.sparkSession.range(1)
        return _table(one, source, [("required_columns", "error", F.lit(False), absent)])
    year = F.year(F.col("invoicedate").try_cast("timestamp_ntz"))
    facts = lines.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("invoice").alias("n_invoice"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    )
    n, first, last = F.col("n"), F.col("first_year"), F.col("last_year")
    usual = first.isNull() | ((first >= MIN_YEAR) & (last <= MAX_YEAR))
    return _table(
        facts,
        source,
        [
            ("not_empty", "error", n > 0, n),
            ("required_columns", "error", F.lit(True), absent),
            ("invoice_not_all_null", "error", F.col("n_invoice") > 0, F.col("n_invoice")),
            ("enough_rows", "warning", n >= MIN_LOAD_ROWS, n),
            ("some_valid_date", "warning", first.isNotNull(), first),
            ("usual_years", "warning", usual, F.concat_ws("-", first, last)),
        ],
    )


def schema_match(a: DataFrame, b: DataFrame, source: str) -> DataFrame:
    """Warns when two yearly tables do not have the same columns."""
    differing = sorted(set(a.columns) ^ set(b.columns))
    return _table(
        a.sparkSession.range(1),
        source,
        [("same_columns", "warning", F.lit(not differing), F.lit(", ".join(differing)))],
    )


def final_assertions(lines: DataFrame, config: CleaningConfig) -> DataFrame:
    """``(check, violations, passed, observed)`` for the cleaned table.

    One aggregate per key, then one over all keys. A null date violates the
    date range; a null price does not violate the price rule. ``observed`` is the
    range of dates found.
    """
    date = F.col("invoicedate")
    in_range = p.holds(
        date.between(
            F.lit(config.date_min).cast("timestamp_ntz"),
            F.lit(config.date_max).cast("timestamp_ntz"),
        )
    )
    per_key = lines.groupBy("invoice", "stockcode").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(p.is_nonpositive_price_sale()).alias("bad_price"),
        F.count_if(~in_range).alias("bad_date"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    violations = {
        "unique_invoice_stockcode": total(F.col("n") - 1),
        "positive_sale_price": total(F.col("bad_price")),
        "date_in_range": total(F.col("bad_date")),
    }
    stamps = (F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in (F.min("first_date"), F.max("last_date")))
    row = per_key.agg(*(v.alias(k) for k, v in violations.items()), F.concat_ws(" to ", *stamps).alias("span"))
    observed = {"date_in_range": F.col("span")}
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(name).alias("violations"),
            (F.col(name) == 0).alias("passed"),
            observed.get(name, F.lit("")).alias("observed"),
        )
        for name in violations
    ]
    return row.select(F.inline(F.array(*entries)))


def enforce(checks: DataFrame) -> None:
    """Raise on failed errors and assertions, warn on failed warnings."""
    failed = [r.asDict() for r in checks.where(~F.col("passed")).collect()]
    for row in failed:
        if row.get("severity") == "warning":
            warnings.warn(f"{row['source']}: {row['check']}: {row['observed']}")
    fatal = [r for r in failed if r.get("severity") != "warning"]
    if fatal:
        raise ValueError(f"failed checks: {fatal}")
