"""Removal of lines that many documents share.

Two Bloom filters hold the hashes of line keys met once and met again. Each
task fills its own pair; pairs are merged by segment, so that a bit both tasks
have met once counts as met again. Only lines that the second filter suspects
are shuffled: their keys are counted exactly, and the documents that hold a
condemned key are joined with the keys they lose. Other documents never leave
their task.

The filters grow with the number of lines up to ``MAX_BITS``, which bounds what
is broadcast. Beyond, more lines are suspected without need and are counted
exactly all the same.

Cases: a null or empty text is one empty line; empty keys are never dropped;
every row counts as a document, so repeated rows count as often as they occur;
a key counts once in a document; a document that loses every line keeps an
empty text; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import SPACES, gives_back, mix64, packed, row_key, small_batches
from ledgerlint.sources.staging import stage

#: Bits of a filter for each line, and at most.
BITS_PER_LINE = 8
MAX_BITS = 1 << 26
PROBES = 3
SEGMENT_BYTES = 4096
#: Documents hashed at a time.
BLOCK = 512

_FILTER_SCHEMA = "segment int, once binary, twice binary"
_SPACES = SPACES.encode()


def keys_of(text: str | None, min_chars: int) -> list[bytes]:
    """The key of every line: stripped, A-Z lower-cased; empty if too short."""
    keys = [x.strip(_SPACES).lower() for x in (text or "").encode().split(b"\n")]
    if min_chars > 1:
        keys = [k if len(k) >= min_chars and len(k.decode()) >= min_chars else b"" for k in keys]
    return keys


def hash_keys(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _hash_texts(texts: list, min_chars: int) -> tuple[list[list[bytes]], np.ndarray]:
    """Distinct keys of each text, and all their hashes end to end."""
    lists = []
    for text in texts:
        found = set(keys_of(text, min_chars))
        found.discard(b"")
        lists.append(sorted(found))
    return lists, hash_keys([k for keys in lists for k in keys])


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash, one row for each probe."""
    a = mix64(hashes)
    step = (a >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        rows = [(a + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]
    return np.stack(rows).astype(np.int64)


def _fill(bits: int, min_chars: int):
    @gives_back
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(bits, dtype=bool)
        twice = np.zeros(bits, dtype=bool)
        for batch in batches:
            values = batch.column(0).to_pylist()
            for start in range(0, len(values), BLOCK):
                _, hashes = _hash_texts(values[start : start + BLOCK], min_chars)
                at, seen = np.unique(_probes(hashes, bits), return_counts=True)
                twice[at] |= once[at] | (seen > 1)
                once[at] = True
        yield from _segments(np.packbits(once), np.packbits(twice))

    return fill


def _segments(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = min(SEGMENT_BYTES, len(once))
    filled = np.flatnonzero(once.reshape(-1, width).any(axis=1))
    for part in np.array_split(filled, max(1, len(filled) // 256)):
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array(part, pa.int32()),
                "once": pa.array([once[i * width : (i + 1) * width].tobytes() for i in part], pa.binary()),
                "twice": pa.array([twice[i * width : (i + 1) * width].tobytes() for i in part], pa.binary()),
            }
        )


@gives_back
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
            if segment in held:
                x, y = held[segment]
                b = b | y | (a & x)
                a = a | x
            held[segment] = (a, b)
    for segment, (a, b) in held.items():
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array([segment], pa.int32()),
                "once": pa.array([a.tobytes()], pa.binary()),
                "twice": pa.array([b.tobytes()], pa.binary()),
            }
        )


def bloom_bits(rows: int) -> int:
    """Bits of a filter for so many hashes: a power of two within the bounds."""
    return min(MAX_BITS, 1 << max(10, (BITS_PER_LINE * rows - 1).bit_length()))


def filters(texts: DataFrame, bits: int, min_chars: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The packed filters of line keys met at all and met again, of ``bits`` bits.

    ``texts`` has one text column. What reaches the driver is at most the two
    filters, whatever the input.
    """
    partial = texts.mapInArrow(_fill(bits, min_chars), _FILTER_SCHEMA)
    merged = partial.repartition("segment").mapInArrow(_merge, _FILTER_SCHEMA)
    width = min(SEGMENT_BYTES, bits // 8)
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for segment, a, b in merged.toLocalIterator():
        once[segment * width : (segment + 1) * width] = np.frombuffer(a, np.uint8)
        twice[segment * width : (segment + 1) * width] = np.frombuffer(b, np.uint8)
    return once, twice


def holds(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter holds; it may say so of some it was not given."""
    hit = np.ones(len(hashes), dtype=bool)
    for at in _probes(hashes, len(packed) * 8):
        hit &= (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return hit


def _suspects(held, min_chars: int):
    """(row, key) of the line keys that a filter holds."""

    @gives_back
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(rows), BLOCK):
                lists, hashes = _hash_texts(texts[start : start + BLOCK], min_chars)
                hit = iter(holds(held.value, hashes).tolist())
                found = [
                    (row, key) for row, keys in zip(rows[start : start + BLOCK], lists) for key in keys if next(hit)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([r for r, _ in found], pa.string()),
                        "key": pa.array([k.decode() for _, k in found], pa.string()),
                    }
                )

    return suspects


def _touched(held, min_chars: int) -> Column:
    """Whether a filter holds any line key of the text."""

    @F.pandas_udf("boolean")
    def touched(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        for start in range(0, len(texts), BLOCK):
            lists, hashes = _hash_texts(texts.iloc[start : start + BLOCK].tolist(), min_chars)
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            out[start + owner[holds(held.value, hashes)]] = True
        return pd.Series(out)

    return touched("text")


def _without() -> Column:
    """n_dropped and kept: the text without the lines whose keys are in __gone."""

    @F.pandas_udf("n_dropped long, kept string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        counts, kept = [], []
        for one, gone in zip(texts, lists):
            gone = {k.encode() for k in gone} if gone is not None else ()
            lines = (one or "").split("\n")
            rest = [x for x, k in zip(lines, keys_of(one, 1)) if k not in gone] if gone else lines
            counts.append(len(lines) - len(rest))
            kept.append("\n".join(rest))
        return pd.DataFrame({"n_dropped": counts, "kept": kept})

    return cut("text", "gone")


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept: the text without shared lines.

    Keys of at least ``min_chars`` code points (1 or more) found in at least
    ``min_docs`` documents lose all their lines. ``docs`` is read several times.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    text = F.coalesce("text", F.lit(""))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    bits = bloom_bits(docs.agg(F.sum(n_lines)).first()[0] or 0)
    _, twice = filters(docs.select("text"), bits, min_chars)

    # Exact confirmation: only suspected keys are shuffled.
    slim = docs.select(row_key("doc_id", "text").alias("row"), "text")
    pairs = stage(
        slim.mapInArrow(_suspects(context.broadcast(twice), min_chars), "row string, key string"), "suspects"
    )
    condemned = stage(pairs.groupBy("key").count().where(F.col("count") >= min_docs).select("key"), "condemned")
    losses = pairs.join(condemned, "key", "left_semi").groupBy("row").agg(F.collect_set("key").alias("gone"))

    # A filter of the condemned keys tells which documents need the join.
    met, _ = filters(condemned, bits, min_chars)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    kept_columns = [F.col("doc").getField(c).alias(c) for c in names]
    marked = docs.select(packed(docs), "text", row_key("doc_id", "text").alias("row"), n_lines.alias("n_lines"))
    marked = marked.withColumn("touched", _touched(context.broadcast(met), min_chars))
    clean = marked.where("NOT touched").select(
        *kept_columns, "n_lines", F.lit(0).cast("long").alias("n_dropped"), text.alias("kept")
    )
    cut = marked.where("touched").join(losses, "row", "left").withColumn("cut", _without())
    return clean.unionByName(cut.select(*kept_columns, "n_lines", F.col("cut.n_dropped"), F.col("cut.kept")))


def digests(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each document."""
    out = drop_shared_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
