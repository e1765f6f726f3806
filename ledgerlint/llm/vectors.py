"""Reading columns of vectors for the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """True for vectors without null or non-finite components and not all zero."""
    values = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0.0), F.lit(False))


def doubles(vector: str = "embedding") -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def matrix(column) -> np.ndarray:
    """The rows of a column of vectors of one length."""
    return np.array([np.asarray(x, dtype=np.float64) for x in column])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component goes first, lest squares overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def count_by(df: DataFrame, *columns: str) -> dict:
    """Row counts of a few groups."""
    return {tuple(r[c] for c in columns): r["count"] for r in df.groupBy(*columns).count().collect()}
