"""Completeness, cardinality and business-rule metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlint.config import HIGH_NULL_PCT
from ledgerlint.functions import predicates as p
from ledgerlint.functions.columns import order_key, pct

HEAD_ROWS = 50


def counted(lines: DataFrame, label: str, conditions: Mapping[str, Column]) -> DataFrame:
    """``(<label>, row_count, total_count)`` for many conditions in one scan."""
    row = lines.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())),
    )
    entries = [
        F.struct(
            F.lit(name).alias(label),
            F.col(f"c{i}").alias("row_count"),
            F.col("total").alias("total_count"),
        )
        for i, name in enumerate(conditions)
    ]
    return row.select(F.inline(F.array(*entries)))


def schema_overview(lines: DataFrame, examples: int = 3) -> DataFrame:
    """Per column: type and its first non-null values, with table totals.

    One top-k scan usually shows enough values of every column. A column too
    sparse for that gets a scan of its own.
    """
    spark = lines.sparkSession
    order = order_key(lines.columns)
    text = [F.col(c).cast("string").alias(c) for c in lines.columns]
    head = lines.orderBy(*order).limit(HEAD_ROWS).select(*text).collect()
    records = []
    for field in lines.schema.fields:
        shown = [r[field.name] for r in head if r[field.name] is not None][:examples]
        if len(shown) < examples and len(head) == HEAD_ROWS:
            filled = lines.where(F.col(field.name).isNotNull())
            rows = filled.orderBy(*order).limit(examples).select(
                F.col(field.name).cast("string").alias("v")
            )
            shown = [r["v"] for r in rows.collect()]
        records.append((field.name, field.dataType.simpleString(), ", ".join(shown)))
    overview = spark.createDataFrame(
        records, "column_name string, data_type string, example_values string"
    )
    return overview.withColumns(
        {
            "total_columns": F.lit(len(records)).cast("long"),
            "total_rows": F.lit(lines.count()),
        }
    )


def null_conditions(lines: DataFrame) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in lines.columns}


def null_report(counts: DataFrame) -> DataFrame:
    nulls, total = F.col("row_count"), F.col("total_count")
    return counts.select(
        "column_name",
        nulls.alias("null_count"),
        pct(nulls, total).alias("null_pct"),
        (total - nulls).alias("non_null_count"),
    )


def null_counts(lines: DataFrame) -> DataFrame:
    return null_report(counted(lines, "column_name", null_conditions(lines)))


def high_null_columns(lines: DataFrame) -> DataFrame:
    return null_counts(lines).where(F.col("null_pct") > HIGH_NULL_PCT)


def _lane(field: T.StructField) -> str:
    """The kind of value a column's values are compared as."""
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return "real"
    if isinstance(field.dataType, (T.IntegralType, T.BooleanType, T.TimestampNTZType, T.TimestampType, T.DateType)):
        return "whole"
    return "text"


def _as_lane(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(field.dataType, T.TimestampNTZType):
        # Microseconds, without passing through a time zone.
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", start, value)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(value)
    return value.cast({"real": "double", "whole": "long", "text": "string"}[_lane(field)])


def _approximate_counts(lines: DataFrame) -> DataFrame:
    """A sketch of a fixed size for each column, all in one scan."""
    row = lines.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.approx_count_distinct(f"`{c}`").alias(f"c{i}") for i, c in enumerate(lines.columns)),
    )
    entries = [
        F.struct(F.lit(i).alias("column"), F.col(f"c{i}").alias("found"), "total") for i in range(len(lines.columns))
    ]
    return row.select(F.inline(F.array(*entries)))


def unique_counts(lines: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, in one scan.

    Every line yields a row (column number, value) for each column. They are
    combined by hash before the one exchange of values, so a value that repeats
    travels once per task; the second exchange has a row per column and task.
    Values are compared by type: text, whole numbers and real numbers each have a
    field of their own. ``approximate`` uses sketches and exchanges nothing else.
    """
    fields = lines.schema.fields
    if approximate:
        counts = _approximate_counts(lines)
    else:
        kinds = {"text": "string", "whole": "long", "real": "double"}
        cells = [
            F.struct(
                F.lit(i).alias("column"),
                *((_as_lane(f) if _lane(f) == k else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()),
            )
            for i, f in enumerate(fields)
        ]
        values = lines.select(F.inline(F.array(*cells))).groupBy("column", *kinds).agg(F.count(F.lit(1)).alias("n"))
        held = F.col("text").isNotNull() | F.col("whole").isNotNull() | F.col("real").isNotNull()
        counts = values.groupBy("column").agg(F.count_if(held).alias("found"), F.sum("n").alias("total"))
    names = lines.sparkSession.createDataFrame(
        [(i, f.name) for i, f in enumerate(fields)], "column int, column_name string"
    )
    found, total = F.coalesce("found", F.lit(0)), F.coalesce("total", F.lit(0))
    return names.join(counts, "column", "left").select(
        "column_name", found.alias("unique_count"), pct(found, total).alias("unique_pct"), total.alias("total_count")
    )


def sanity_conditions() -> dict[str, Column]:
    return {
        "missing_customer_id": F.col("customer_id").isNull(),
        "nonpositive_quantity_sale": p.is_nonpositive_quantity_sale(),
        "nonpositive_price_sale": p.is_nonpositive_price_sale(),
        "credit_note": p.is_credit(),
    }


def sanity_report(counts: DataFrame) -> DataFrame:
    return counts.select(
        "metric",
        "row_count",
        pct(F.col("row_count"), F.col("total_count")).alias("row_pct"),
    )


def sanity_metrics(lines: DataFrame) -> DataFrame:
    """``(metric, row_count, row_pct)``, all from one scan without a shuffle of rows."""
    return sanity_report(counted(lines, "metric", sanity_conditions()))


def duplicate_rows(lines: DataFrame) -> DataFrame:
    """Rows beyond the first of each distinct line."""
    distinct = lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return distinct.agg(
        extra.alias("duplicate_count"),
        total.alias("total_count"),
        pct(extra, total).alias("duplicate_pct"),
    )


def date_coverage(lines: DataFrame) -> DataFrame:
    """First and last day and the whole days between; bad dates are ignored."""
    when = F.col("invoicedate").try_cast("timestamp_ntz")
    span = lines.agg(F.min(when).alias("first"), F.max(when).alias("last"))
    return span.select(
        F.date_format("first", "yyyy-MM-dd").alias("date_min"),
        F.date_format("last", "yyyy-MM-dd").alias("date_max"),
        F.timestamp_diff("DAY", F.col("first"), F.col("last")).alias("duration_days"),
    )


def top_countries(lines: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` countries with most lines; shares refer to all lines."""
    per_country = lines.groupBy("country").agg(F.count(F.lit(1)).alias("row_count"))
    totals = per_country.agg(
        F.struct(F.sum("row_count").alias("n"), F.count("country").alias("countries"))
    )
    ranked = (
        per_country.where(F.col("country").isNotNull())
        .orderBy(F.desc("row_count"), "country")
        .limit(k)
    )
    whole = totals.scalar()
    return ranked.select(
        "country",
        "row_count",
        pct(F.col("row_count"), whole["n"]).alias("row_pct"),
        whole["countries"].alias("total_countries"),
    )
