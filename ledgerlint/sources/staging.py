"""Intermediate tables that several passes read.

A staged table is plain Parquet in the shared folder named by
``spark.checkpoint.dir``: it survives the loss of executors, cuts lineage, and
later passes read only the columns they need. Tables lie under
``<folder>/ledgerlint/<application id>``; results are lazy over them, so they stay
until the application ends or ``drop_staged`` is called. A table that nothing reads
any more, because what came of it is stored itself, can go at once (``discard``). Shuffle files of the write
go when it has ended; Spark would keep them until the driver happens to collect its garbage. In local mode, where the
setting is optional, a temporary folder is made once and removed at exit. A bare path is resolved against the
default file system, as by Spark: whoever sets it vouches that all executors share the folder.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
#: Whether Spark removes the shuffle files of a query when it ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def staging_dir(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="ledgerlint-")
            atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
        base = _LOCAL_DIRS[app]
    return f"{base.rstrip('/')}/ledgerlint/{app}"


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove all tables staged by this application; results over them end with them."""
    _remove(spark, staging_dir(spark))


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that no frame in use reads; others are left alone.

    ``tables`` are frames as ``stage`` returned them.
    """
    for table in tables:
        if path := _PATHS.pop(table, None):
            _remove(table.sparkSession, path)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with _shuffles_go(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _PATHS[stored] = path
    return stored
