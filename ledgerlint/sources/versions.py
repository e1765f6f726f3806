"""A stored table that knows the files it was made from.

A table is a folder of versions, and numbered manifests that name one version each
and list its source files with size, time and SHA-256 digest. The manifest with the
highest number counts. It is written under another name and renamed, so it is there
as a whole or not at all: a writer that dies half-way leaves files that no manifest
names, and the version before stays in force.

A version is used again as long as its sources are the same. Size and time tell most
of that from a listing alone; only files whose time differs are read and compared by
digest. The version before the current one is kept, for those who still read it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from ledgerlint.sources.manifest import SourceFile, hash_listed, list_files
from ledgerlint.sources.tables import read_lines, write_lines

BUILT, REUSED, REBUILT = "built", "reused", "rebuilt"
_NAME = re.compile(r"^manifest-(\d{9})\.json$")


@dataclass(frozen=True)
class Source:
    """A source file of a version."""

    file: SourceFile
    sha256: str


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    sources: tuple[Source, ...]


class _Folder:
    """The few operations on the table's folder, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._fs: JavaObject = self._path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def names(self, inside: str = "") -> list[str]:
        place = self._path(f"{self.path}/{inside}" if inside else self.path)
        if not self._fs.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(place))

    def read(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()["value"]

    def publish(self, name: str, text: str) -> None:
        """Write a new file as a whole; fails if there is one of that name."""
        hidden = self._path(f"{self.path}/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(f"{self.path}/{name}")
        if self._fs.exists(target) or not self._fs.rename(hidden, target):
            self._fs.delete(hidden, False)
            raise RuntimeError(f"{name} was published by another writer")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


def _versions(folder: _Folder) -> list[int]:
    return [int(m[1]) for name in folder.names() if (m := _NAME.match(name))]


def _manifest(number: int) -> str:
    return f"manifest-{number:09d}.json"


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The version in force, if there is one."""
    folder = _Folder(spark, path)
    numbers = _versions(folder)
    if not numbers:
        return None
    held = json.loads(folder.read(_manifest(max(numbers))))
    sources = tuple(Source(SourceFile(**s["file"]), s["sha256"]) for s in held["sources"])
    return Version(max(numbers), held["folder"], sources)


def _publish(folder: _Folder, version: Version) -> None:
    content = {"folder": version.folder, "sources": [asdict(s) for s in version.sources]}
    folder.publish(_manifest(version.number), json.dumps(content))
    # The one before stays readable; what it replaced goes, and so do its files.
    old = [n for n in _versions(folder) if n < version.number - 1]
    kept = {version.folder}
    if version.number - 1 in _versions(folder):
        kept.add(json.loads(folder.read(_manifest(version.number - 1)))["folder"])
    for number in old:
        unused = json.loads(folder.read(_manifest(number)))["folder"]
        folder.remove(_manifest(number))
        if unused not in kept:
            folder.remove(unused)


def _digests(spark: SparkSession, files: list[SourceFile]) -> dict[str, str]:
    return {r["uri"]: r["sha256"] for r in hash_listed(spark, files).collect()} if files else {}


def _same_sources(spark: SparkSession, held: Version, now: list[SourceFile]) -> tuple[Source, ...] | None:
    """The sources as they are listed now if their contents are those of ``held``."""
    before = {s.file.uri: s for s in held.sources}
    if before.keys() != {f.uri for f in now} or any(f.n_bytes != before[f.uri].file.n_bytes for f in now):
        return None
    touched = [f for f in now if f.modified != before[f.uri].file.modified]
    digests = _digests(spark, touched)
    if any(digests[f.uri] != before[f.uri].sha256 for f in touched):
        return None
    return tuple(replace(before[f.uri], file=f) for f in now)


def read_or_rebuild(
    spark: SparkSession, path: str, sources: str | list[str], build: Callable[[], DataFrame]
) -> tuple[DataFrame, str]:
    """The table at ``path``, and whether it was built, reused or rebuilt.

    ``sources`` are the paths or patterns of the files that ``build`` reads.
    """
    folder, held = _Folder(spark, path), current_version(spark, path)
    files = list_files(spark, sources)
    if held is not None and (same := _same_sources(spark, held, files)) is not None:
        if same != held.sources:
            _publish(folder, Version(held.number + 1, held.folder, same))
        return read_lines(spark, f"{folder.path}/{held.folder}"), REUSED
    # Digests are taken before the build: a file that changes meanwhile differs next time.
    digests = _digests(spark, files)
    name = f"version-{uuid.uuid4().hex}"
    write_lines(build(), f"{folder.path}/{name}")
    made = Version(held.number + 1 if held else 1, name, tuple(Source(f, digests[f.uri]) for f in files))
    _publish(folder, made)
    return read_lines(spark, f"{folder.path}/{name}"), REBUILT if held else BUILT
