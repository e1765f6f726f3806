"""Joining a group-level value back to the rows of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_GROUPS = 1000
HOT_ROWS = 100_000


def complete(keys: Sequence[str]) -> Column:
    """True where every key is set."""
    full = F.lit(True)
    for key in keys:
        full = full & F.col(key).isNotNull()
    return full


def attach_group_values(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, hot_rows: int | None = None
) -> DataFrame:
    """Left join of ``rows`` with ``groups``, which has one row per key.

    ``size`` names the column of ``groups`` that counts the rows of each key.
    A shuffle join would send a hot group to one task, and adaptive skew
    handling does not reach below an aggregate. So groups with more than a
    ``HOT_GROUPS``-th of all rows are broadcast: by their sizes there are fewer
    than ``HOT_GROUPS`` of them, whatever the data. Groups of up to ``hot_rows``
    (by default ``HOT_ROWS``) rows never count as hot. All other rows are joined by shuffle, and rows
    without a key are not joined at all.

    Both inputs are read several times: pass stored tables.
    """
    keys = list(keys)
    values = [f for f in groups.schema.fields if f.name not in (*keys, size)]
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) > F.lit(max(total // HOT_GROUPS, HOT_ROWS if hot_rows is None else hot_rows))
    cold = groups.where(~is_hot).drop(size)
    keyed = rows.where(complete(keys))
    loose = rows.where(~complete(keys)).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in values}
    )
    if groups.where(is_hot).isEmpty():
        joined = keyed.join(cold, keys, "left")
    else:
        hot = F.broadcast(groups.where(is_hot).drop(size))
        joined = keyed.join(hot, keys).unionByName(
            keyed.join(hot.select(*keys), keys, "left_anti").join(cold, keys, "left")
        )
    return joined.unionByName(loose).select(*rows.columns, *(f.name for f in values))
