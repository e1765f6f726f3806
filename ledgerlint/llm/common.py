"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns in one, named ``doc``, so that no name clashes with an operator's own."""
    names = ("`" + c.replace("`", "``") + "`" for c in docs.columns)
    return F.struct(*map(F.col, names)).alias("doc")


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand texts to Python in Arrow batches of at most so many rows.

    The default of 10,000 rows takes hundreds of megabytes of a worker where
    texts are long. A smaller setting is left as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows no label may be learnt from: crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def row_key(*columns: str) -> Column:
    """128 bits that tell rows apart; nulls differ from every value."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit integers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def flat(lists, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists end to end, and the length of each list."""
    arrays = [np.asarray(x, dtype=dtype) if x is not None else np.empty(0, dtype) for x in lists]
    lengths = np.array([len(a) for a in arrays], dtype=np.int64)
    return (np.concatenate(arrays) if arrays else np.empty(0, dtype)), lengths


def gives_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that hands freed memory back when it ends.

    Workers are used again by later stages; what their allocators keep would count
    against the executor until then.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        # Only the GNU C library has it.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run
