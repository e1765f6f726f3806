"""File digests.

Each file is hashed by one task in fixed-size chunks, so neither the 2 GB
limit of a binary column nor executor memory bounds the file size. Files are dealt
to tasks by their sizes, the largest first, each to the task with least to read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHUNK = 8 * 1024 * 1024
TASKS_PER_CORE = 4
#: What opening a file costs, in bytes read meanwhile.
OPEN_COST = 1024 * 1024


@dataclass(frozen=True)
class SourceFile:
    """A file as its file system lists it; ``modified`` is in microseconds."""

    uri: str
    n_bytes: int
    modified: int

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _digest(uri: str) -> tuple[int, str]:
    from pyarrow import fs

    # Spark's names for object stores that the file system library knows by others.
    for spark_name, name in (("s3a://", "s3://"), ("s3n://", "s3://"), ("wasbs://", "abfss://")):
        if uri.startswith(spark_name):
            uri = name + uri[len(spark_name):]
    filesystem, path = fs.FileSystem.from_uri(uri)
    digest, size = hashlib.sha256(), 0
    with filesystem.open_input_stream(path) as stream:
        while chunk := stream.read(_CHUNK):
            digest.update(chunk)
            size += len(chunk)
    return size, digest.hexdigest()


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        done = [(uri, *_digest(uri)) for uri in batch["uri"]]
        yield pd.DataFrame(done, columns=["uri", "n_bytes", "sha256"])


def _plain(uri: str) -> str:
    return re.sub("^file:/+", "file:///", uri)


def list_files(spark: SparkSession, path: str | list[str]) -> list[SourceFile]:
    """The files below a path or pattern, by name. Contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    found = files.select(
        F.input_file_name().alias("uri"), "length", F.unix_micros("modificationTime").alias("modified")
    ).collect()
    known = {_plain(r["uri"]): SourceFile(_plain(r["uri"]), r["length"], r["modified"]) for r in found}
    # From the file index: a scan leaves out empty files.
    for uri in map(_plain, files.inputFiles()):
        known.setdefault(uri, SourceFile(uri, 0, 0))
    return [known[uri] for uri in sorted(known)]


def deal(files: Iterable[SourceFile], parts: int) -> list[tuple[str, int]]:
    """(uri, part): the largest file first, to the part that has least to read."""
    load = [(0, part) for part in range(parts)]
    dealt = []
    for file in sorted(files, key=lambda f: (-f.n_bytes, f.uri)):
        total, part = heapq.heappop(load)
        dealt.append((file.uri, part))
        heapq.heappush(load, (total + file.n_bytes + OPEN_COST, part))
    return dealt


def hash_listed(spark: SparkSession, files: list[SourceFile]) -> DataFrame:
    """``(uri, n_bytes, sha256)`` of listed files, hashed by many tasks."""
    parts = max(1, min(len(files), TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    listing = spark.createDataFrame(deal(files, parts), "uri string, part int")
    return listing.repartitionById(parts, "part").select("uri").mapInPandas(
        _hash_batches, "uri string, n_bytes long, sha256 string"
    )


def hash_files(spark: SparkSession, path: str) -> DataFrame:
    """``(uri, n_bytes, sha256)`` per file below a path or pattern."""
    return hash_listed(spark, list_files(spark, path))


def file_manifest(
    spark: SparkSession, path: str, expected: Mapping[str, str] | None = None
) -> DataFrame:
    """``(file_name, n_bytes, sha256, expected_sha256, matches)`` per file.

    ``matches`` is null where no digest is expected for the file.
    """
    hashed = hash_files(spark, path)
    digests = spark.createDataFrame(
        list((expected or {}).items()), "file_name string, expected_sha256 string"
    )
    # URIs escape special characters; a plus sign stands for itself.
    name = F.replace(F.element_at(F.split("uri", "/"), -1), F.lit("+"), F.lit("%2B"))
    return (
        hashed.withColumn("file_name", F.url_decode(name))
        .join(digests, "file_name", "left")
        .select(
            "file_name",
            "n_bytes",
            "sha256",
            "expected_sha256",
            (F.col("sha256") == F.lower("expected_sha256")).alias("matches"),
        )
    )


def enforce_manifest(manifest: DataFrame) -> None:
    """Raise when a file differs from its expected digest."""
    wrong = manifest.where(~F.col("matches")).select("file_name").collect()
    if wrong:
        raise ValueError(f"SHA-256 mismatch: {sorted(r.file_name for r in wrong)}")
