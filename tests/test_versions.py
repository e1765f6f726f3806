from __future__ import annotations

import os
from pathlib import Path

import pytest

from ledgerlint.sources import versions
from ledgerlint.sources.manifest import SourceFile, deal, list_files
from ledgerlint.sources.tables import write_lines
from ledgerlint.sources.versions import current_version, read_or_rebuild
from tests.helpers import column, line, lines


class Table:
    def __init__(self, spark, folder: Path):
        self.spark, self.path, self.incoming = spark, str(folder / "table"), folder / "incoming"
        self.builds = 0

    def arrive(self, name, *rows):
        write_lines(lines(self.spark, list(rows)).coalesce(1), str(self.incoming / name), mode="overwrite")

    def build(self):
        self.builds += 1
        return self.spark.read.parquet(f"{self.incoming}/*")

    def read(self):
        table, action = read_or_rebuild(self.spark, self.path, f"{self.incoming}/*", self.build)
        return sorted(column(table, "invoice")), action


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


def test_reused_until_a_source_changes(table):
    table.arrive("a", line(invoice="1"))
    assert table.read() == (["1"], "built")
    assert table.read() == (["1"], "reused")
    table.arrive("b", line(invoice="2"))
    assert table.read() == (["1", "2"], "rebuilt")
    table.arrive("b", line(invoice="3"))
    assert table.read() == (["1", "3"], "rebuilt")
    assert table.builds == 3


def test_a_file_with_a_new_time_and_the_same_content_is_not_rebuilt(table):
    table.arrive("a", line(invoice="1"))
    table.read()
    (file,) = (table.incoming / "a").glob("*.parquet")
    os.utime(file, (1, 1))
    assert table.read() == (["1"], "reused")
    held = current_version(table.spark, table.path)
    # The new time is kept, so that the file is not hashed again.
    assert held.number == 2 and [s.file.modified for s in held.sources] == [1_000_000]
    data = file.read_bytes()
    file.write_bytes(data[:-1] + bytes([data[-1] ^ 1]))  # the same size, other content
    os.utime(file, (2, 2))
    with pytest.raises(Exception):
        table.read()


def test_a_writer_that_dies_half_way_leaves_the_old_version(table, monkeypatch):
    table.arrive("a", line(invoice="1"))
    table.read()
    table.arrive("b", line(invoice="2"))

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", dies)  # all data files written, no manifest
        with pytest.raises(KeyboardInterrupt):
            table.read()
    held = current_version(table.spark, table.path)
    assert held.number == 1 and table.spark.read.parquet(f"{table.path}/{held.folder}").count() == 1
    assert table.read() == (["1", "2"], "rebuilt")


def test_two_writers_cannot_publish_the_same_number(table):
    table.arrive("a", line(invoice="1"))
    table.read()
    held = current_version(table.spark, table.path)
    folder = versions._Folder(table.spark, table.path)
    with pytest.raises(RuntimeError, match="another writer"):
        versions._publish(folder, held)
    assert not [n for n in os.listdir(table.path) if n.startswith(".manifest") and not n.endswith(".crc")]


def test_the_version_before_stays_and_older_ones_go(table):
    for i in range(4):
        table.arrive("a", line(invoice=str(i)), line(invoice="x" * (i + 1)))
        table.read()
    names = [n for n in os.listdir(table.path) if not n.startswith(".")]
    assert sorted(n[:8] for n in names) == ["manifest", "manifest", "version-", "version-"]
    assert current_version(table.spark, table.path).number == 4


def test_files_are_dealt_by_size():
    files = [SourceFile("large", 10**9, 0)] + [SourceFile(f"s{i:03d}", 10**6, 0) for i in range(500)]
    parts = dict(deal(files, 16))
    assert [uri for uri, part in parts.items() if part == parts["large"]] == ["large"]
    shares = [sum(f.n_bytes for f in files[1:] if parts[f.uri] == part) for part in set(parts.values()) - {parts["large"]}]
    assert max(shares) <= 500 * 10**6 / 15 + 10**6


def test_listing_holds_empty_files_and_odd_names(spark, tmp_path):
    for name, size in (("a b+c%.bin", 3), ("empty.bin", 0), ("ü.bin", 1)):
        (tmp_path / name).write_bytes(b"x" * size)
    assert sorted(f.n_bytes for f in list_files(spark, f"{tmp_path}/*.bin")) == [0, 1, 3]
