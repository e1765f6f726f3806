"""Byte-level byte-pair encoding and decoding.

Each match of the split pattern is merged separately. A segment tree over its
byte positions holds, at every node, the leftmost pair of the smallest rank
below it; the root is the next merge. A merge links two neighbours and updates
three leaves, so a piece of n bytes takes O(n log n), however long it is. Short
pieces are merged many at a time: their trees are the rows of an array, and each
step makes the next merge of every row.

Ids are kept packed, as little-endian unsigned 32-bit integers: four bytes a
token, the form in which token shards are stored. Pieces repeat, so every task
remembers those it has encoded, up to a fixed number.

The vocabulary is a fixed file, read on the driver and broadcast.

Cases: a null or empty text has no ids and decodes to no bytes; texts of any
length are encoded whole; repeated rows get equal results; an existing column
with the name of an output is replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.llm.common import gives_back, small_batches

#: Encoded pieces a task remembers before it starts anew.
REMEMBERED = 100_000
#: Documents whose new pieces are merged together.
BLOCK = 256
_NONE = 1 << 62


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks of a file whose lines are a token in base64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank_of = ranks.get

    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i  # orders by rank, then from the left
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def update(i: int, end: int) -> None:
        """Leaf i becomes the pair that covers piece[i:end]; no pair if end is 0."""
        rank = rank_of(piece[i:end]) if 0 < end - i <= longest else None
        value = _NONE if rank is None else rank * n + i
        i += size
        tree[i] = value
        while i > 1:
            other = tree[i ^ 1]
            i >>= 1
            low = value if value < other else other
            if tree[i] == low:
                break
            tree[i] = value = low

    while tree[1] != _NONE:
        i = tree[1] % n
        j = after[i]
        end = after[j]
        after[i] = end
        update(j, 0)
        if end < n:
            before[end] = i
            update(i, after[end])
        else:
            update(i, 0)
        if before[i] >= 0:
            update(before[i], end)

    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Merger:
    """Ranks of pairs of tokens, and the lock-step merge of many short pieces."""

    #: Pieces up to this many bytes are merged together, so many at a time.
    SHORT = 64
    TOGETHER = 4096

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        # A pair spells one token only, so none is met twice.
        keys, merged = array("q"), array("q")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; -1 where the vocabulary has no such token."""
        if not len(self.keys):
            return np.full(len(a), -1, dtype=np.int64)
        wanted = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], -1)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > self.SHORT:
                out[i] = np.array(merge(piece, self.ranks, self.longest), dtype="<u4").tobytes()
            else:
                classes.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for depth, members in classes.items():
            for at in range(0, len(members), self.TOGETHER):
                chosen = members[at : at + self.TOGETHER]
                for i, packed in zip(chosen, self._lock_step([pieces[i] for i in chosen], depth)):
                    out[i] = packed
        return out

    def _lock_step(self, pieces: list[bytes], depth: int) -> list[bytes]:
        """Merge pieces of at most 2**depth bytes; a row of each array is a piece."""
        width, n = 1 << depth, len(pieces)
        raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in pieces), np.uint8).reshape(n, width)
        lengths = np.array([len(x) for x in pieces])
        place = np.arange(width)
        live = place < lengths[:, None]
        ids = self.byte_ids[raw]
        after = np.where(place + 1 < lengths[:, None], place + 1, width).ravel()
        before = np.tile(np.append(place - 1, 0), n)  # one more place, for "after the end"
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        first = live[:, 1:].nonzero()
        ranks = self.pair_ranks(ids[first[0], first[1]], ids[first[0], first[1] + 1])
        tree[first[0], width + first[1]] = np.where(ranks < 0, _NONE, ranks << depth | first[1])
        for level in range(depth - 1, -1, -1):
            low, high = 1 << level, 2 << level
            tree[:, low:high] = np.minimum(tree[:, 2 * low : 2 * high : 2], tree[:, 2 * low + 1 : 2 * high : 2])
        ids, live, tree = ids.ravel(), live.ravel(), tree.ravel()

        def update(row, at, value) -> None:
            node = at + width
            base = row * (2 * width)
            tree[base + node] = value
            for _ in range(depth):
                node = node >> 1
                left = base + 2 * node
                tree[base + node] = np.minimum(tree[left], tree[left + 1])

        row = np.arange(n)
        while True:
            root = tree[row * (2 * width) + 1]
            row = row[root != _NONE]
            if not len(row):
                break
            root = root[root != _NONE]
            i, rank = root & (width - 1), root >> depth
            base = row * width
            j = after[base + i]
            k = after[base + j]
            ids[base + i] = rank
            live[base + j] = False
            after[base + i] = k
            before[row * (width + 1) + k] = i
            update(row, j, _NONE)
            inner = k < width
            found = np.full(len(row), -1, dtype=np.int64)
            found[inner] = self.pair_ranks(rank[inner], ids[(base + k)[inner]])
            update(row, i, np.where(found < 0, _NONE, found << depth | i))
            p = before[row * (width + 1) + i]
            inner = p >= 0
            found = self.pair_ranks(ids[(base + p)[inner]], rank[inner])
            update(row[inner], p[inner], np.where(found < 0, _NONE, found << depth | p[inner]))
        packed = ids[live].astype("<u4").tobytes()
        ends = np.cumsum(live.reshape(n, width).sum(axis=1) * 4).tolist()
        return [packed[a:b] for a, b in zip([0] + ends, ends)]


class Encoder:
    """Packed ids of texts; pieces that were met are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merger = Merger(ranks)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        known, out = self.known, []
        for at in range(0, len(texts), BLOCK):
            pieces = [self.split(x) if x else [] for x in texts[at : at + BLOCK]]
            new = list(set().union(*pieces) - known.keys())
            known.update(zip(new, self.merger.encode([x.encode() for x in new])))
            out.extend(b"".join(map(known.__getitem__, x)) for x in pieces)
            if len(known) > REMEMBERED:
                known.clear()
        return out


class Decoder:
    """The bytes that packed ids stand for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def __call__(self, packed: Sequence[bytes | None]) -> list[bytes]:
        token = self.tokens.__getitem__
        return [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) if x else b"" for x in packed]


class Vocabulary:
    """A rank file and its split pattern, shipped to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        # Ids and decoded text of a batch are held beside it.
        small_batches(spark, 500)
        self.raw = spark.sparkContext.broadcast(Path(path).read_bytes())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Packed ids of a text column, as binary."""
        raw, pattern = self.raw, self.pattern

        @F.pandas_udf("binary")
        @gives_back
        def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = Encoder(read_ranks(raw.value), pattern)
            for batch in batches:
                yield pd.Series(encoder(batch.tolist()), dtype=object)

        return packed(text)

    def decode(self, packed: Column) -> Column:
        """The bytes that packed ids stand for, as binary."""
        raw = self.raw

        @F.pandas_udf("binary")
        @gives_back
        def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            decoder = Decoder(read_ranks(raw.value))
            for batch in batches:
                yield pd.Series(decoder(batch.tolist()), dtype=object)

        return unpacked(packed)

    def encode_and_decode(self, text: Column) -> Column:
        """Packed ids of a text column and the bytes that they stand for, as a struct.

        ``decode`` of ``encode`` takes two workers a task, as Spark gives each such
        function its own; this one takes one, with one table of ranks.
        """
        raw, pattern = self.raw, self.pattern

        @F.pandas_udf("ids binary, decoded binary")
        @gives_back
        def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            ranks = read_ranks(raw.value)
            encoder, decoder = Encoder(ranks, pattern), Decoder(ranks)
            for batch in batches:
                ids = encoder(batch.tolist())
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(decoder(ids), dtype=object)})

        return coded(text)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of ``text``."""
    return docs.withColumn(ids, vocabulary.encode(F.col(text)))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that packed ``ids`` stand for."""
    return docs.withColumn(decoded, vocabulary.decode(F.col(ids)))


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    coded = docs.select("doc_id", vocabulary.encode_and_decode(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id",
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
