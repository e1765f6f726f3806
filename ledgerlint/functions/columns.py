"""Small column builders: ordered firsts, percentages, timestamp truncation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Order of a line among lines of the same group. Spark has no row order, so
# "first" means first under these columns, nulls first.
ORDER_KEY = (
    "invoicedate",
    "source_year",
    "description",
    "price",
    "quantity",
    "customer_id",
    "country",
)


def order_key(columns: Iterable[str], exclude: Sequence[str] = ()) -> list[str]:
    """``ORDER_KEY`` limited to ``columns``, then the other columns by name."""
    present = [c for c in columns if c not in exclude]
    known = [c for c in ORDER_KEY if c in present]
    return known + sorted(c for c in present if c not in known)


def first_non_null(column: str, order: Sequence[str]) -> Column:
    """Aggregate: the value of ``column`` in the first row where it is set.

    Under a lexicographic order the answer is fixed by the order columns up to
    and including ``column`` itself, so the buffer that travels through the
    shuffle holds just that prefix. ``min`` combines on the map side, so a hot
    group sends one buffer per task.
    """
    prefix = list(order)
    if column in prefix:
        prefix = prefix[: prefix.index(column) + 1]
    else:
        prefix.append(column)
    ranked = F.min(F.when(F.col(column).isNotNull(), F.struct(*prefix)))
    return ranked.getField(column).alias(column)


def first_non_nulls(columns: Sequence[str], order: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """``first_non_null`` of several columns: aggregates, and the columns made of them afterwards.

    A row in which all of ``columns`` are set is kept as one struct, not as a prefix for
    each column; only rows with nulls have a prefix for each column they set. The first
    value of a column is that of the lesser prefix.
    """
    order = [*order, *(c for c in columns if c not in order)]
    prefixes = {c: order[: order.index(c) + 1] for c in columns}
    whole = order[: max(map(len, prefixes.values()), default=0)]
    holed = F.lit(False)
    for c in columns:
        holed = holed | F.col(c).isNull()
    first = F.col("__first")
    aggregates = {"__first": F.min(F.when(~holed, F.struct(*whole)))} if columns else {}
    results = {}
    for i, c in enumerate(columns):
        aggregates[f"__first{i}"] = F.min(F.when(holed & F.col(c).isNotNull(), F.struct(*prefixes[c])))
        other = F.col(f"__first{i}")
        cut = F.struct(*(first.getField(x).alias(x) for x in prefixes[c]))
        least = F.when(other < cut, other.getField(c)).otherwise(first.getField(c))
        results[c] = F.when(other.isNull(), first.getField(c)).when(first.isNull(), other.getField(c)).otherwise(least).alias(c)
    return aggregates, results


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when there are no rows."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def finite(column: Column) -> Column:
    """The value, or null for null, NaN and infinities."""
    infinity = F.lit(float("inf"))
    return F.when(~F.isnan(column) & (F.abs(column) != infinity), column)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN orders above every number in Spark; treat it as missing instead."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixes) if fixes else df


def truncate_ntz(column: str, unit: str) -> Column:
    """Truncate a zone-less timestamp without passing through a time zone."""
    unit = unit.upper()
    ts = F.col(column)
    day = F.to_date(ts)
    if unit == "DAY":
        return day.cast("timestamp_ntz")
    if unit in ("WEEK", "MONTH", "QUARTER", "YEAR"):
        return F.trunc(day, unit).cast("timestamp_ntz")
    if unit == "MILLISECOND":
        extra = (F.expr(f"extract(SECOND FROM `{column}`)") * 1000000).cast("long") % 1000
        return F.timestamp_add("MICROSECOND", -extra, ts)
    steps = ("HOUR", "MINUTE", "SECOND")
    if unit not in steps:
        raise ValueError(f"unsupported unit: {unit}")
    out = day.cast("timestamp_ntz")
    parts = {"HOUR": F.hour(ts), "MINUTE": F.minute(ts), "SECOND": F.second(ts)}
    for step in steps[: steps.index(unit) + 1]:
        out = F.timestamp_add(step, parts[step], out)
    return out
