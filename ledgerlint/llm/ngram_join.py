"""N-gram Jaccard join by parity sketches.

A document's set of word n-grams is XOR-hashed into a sketch: each n-gram falls
into one of the sketch's words and toggles it with its hash. Two sets differ in
at least as many n-grams as their sketches differ in words. Sets of a band of
sizes that are similar enough differ in at most ``d`` n-grams, so of more than
``d`` words at least one agrees (pigeonhole). Documents are joined on the words
of their sketches, band by band, and candidates are verified on their whole sets.

A set is in the band of its size and, as the larger partner, in the one below.
Empty words agree without meaning anything. A sketch has a few words more than
``d + 1``; a set with fewer empty words than that never needs them. The others,
which are small sets, are sketched again with another seed, on the same grounds.

Documents with equal sets are one node. In each group of nodes that share a word,
nodes first meet one of them, and the nearest they meet in all their groups is
verified; a few such rounds connect a group of copies. What is then still in
different components is compared with all. Nodes are compared by a bit sketch, whose
Hamming distance is a lower bound too; only pairs that it cannot tell apart are
emitted and verified.

What is shuffled is kept small. Sketch words, of which few are met again, travel packed
by bucket, 14 bytes each. Nodes that meet are paired by name before their bit sketches
are fetched, as copies share many words. Texts are shuffled only where a Bloom filter of
bounded size suspects that their row is wanted; the exact join decides.

Cases: null and empty texts have the empty set and link with nothing; a text with
fewer words than ``n`` has its whole sequence as its one n-gram; equal texts are
in one component; repeated rows are all returned; null ids are never the name of
a component unless all its ids are null; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import gives_back, mix64, packed, row_key, small_batches, unpacked
from ledgerlint.llm.graph import components
from ledgerlint.llm.line_dedup import bloom_bits, filters, hash_keys, holds
from ledgerlint.sources.staging import discard, stage

#: Documents worked on at a time, and words whose hash a task remembers.
BLOCK = 128
REMEMBERED = 200_000
#: Sketches that are made in turn for sets with too many empty words.
SEEDS = 12
#: Rounds in which each node meets one node of each of its groups and the nearest of
#: these is verified, before all that is left is compared.
STAR_ROUNDS = 4
#: Bits of the sketch that candidates are compared by.
BITS = 1024
#: Buckets that sketch words are dealt into: a power of two.
BUCKET_BITS = 12
#: Bits of a word that name it within its bucket; six bytes.
WORD_BITS = 48
#: Words that a task packs, or whose company it looks for, at a time, at least.
HELD_WORDS = 1 << 19


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def ngram_sets(texts: list, n: int, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, end to end and sorted, and the set sizes."""
    lists = [(x or "").encode().lower().split() for x in texts]
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    grams = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    total = int(sizes.sum())
    hashes = np.fromiter((words[w] for x in lists for w in x), np.uint64, total)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), grams)
    first = np.repeat(starts, grams) + np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams)
    left = np.repeat(np.minimum(sizes, n), grams)  # tokens of each n-gram
    value = mix64(left.astype(np.uint64))
    for i in range(n):
        inside = left > i
        value[inside] = mix64(value[inside] ^ hashes[first[inside] + i])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def _nodes(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits that name each set."""
    ends = np.cumsum(sizes)
    out = np.empty(len(sizes), np.int64)
    for i, (a, b) in enumerate(zip(ends - sizes, ends)):
        out[i] = int.from_bytes(hashlib.blake2b(value[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
    return out


class Bands:
    """Sizes, differences and sketch widths for a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def difference(self, a: int, b: int) -> int:
        """Most elements in which similar sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def of(self, largest: int) -> list[tuple[int, int, int, int]]:
        """(least size, largest size, d, words) of each band up to a size."""
        out, start = [], 1
        while start <= largest:
            end = start * self.den // self.num
            d = self.difference(end, end * self.den // self.num)
            words = d + 1
            if d:
                empty = np.exp(-start / words)
                words += int(np.ceil(1.5 * words * empty)) if words > 8 else 0
            out.append((start, end, d, words))
            start = end + 1
        return out


def sketch_keys(value: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, bands: list) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) of the sketch words on which each set is joined."""
    starts = np.array([b[0] for b in bands], dtype=np.int64)
    ends = np.cumsum(sizes)
    own = np.searchsorted(starts, sizes, side="right") - 1
    keys, names = [], []
    for below in (0, 1):
        band = own - below
        usable = (sizes > 0) & (band >= 0)
        todo = [i for i in np.flatnonzero(usable) if bands[band[i]][2] > 0]
        for seed in range(SEEDS):
            if not todo:
                break
            chosen = np.array(todo)
            width = np.array([bands[band[i]][3] for i in todo], dtype=np.int64)
            spare = width - 1 - np.array([bands[band[i]][2] for i in todo], dtype=np.int64)
            count = sizes[chosen]
            at = np.repeat(ends[chosen] - count, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            h = mix64(value[at] + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % (1 << 64)))
            word = (h >> np.uint64(20)) % np.repeat(width, count).astype(np.uint64)
            # One word is the XOR of the hashes that fall into it.
            place = word.astype(np.int64) + np.repeat(np.cumsum(width) - width, count)
            order = np.argsort(place, kind="stable")
            sorted_place = place[order]
            first = np.flatnonzero(np.r_[True, sorted_place[1:] != sorted_place[:-1]])
            parity = np.bitwise_xor.reduceat(mix64(h[order]), first) if len(first) else np.empty(0, np.uint64)
            filled = sorted_place[first]
            owner = np.searchsorted(np.cumsum(width), filled, side="right")
            empty = width - np.bincount(owner, minlength=len(todo))
            salt = mix64(
                (band[chosen][owner].astype(np.uint64) << np.uint64(40))
                ^ (filled - (np.cumsum(width) - width)[owner]).astype(np.uint64) ^ np.uint64(seed << 56)
            )
            keys.append(mix64(parity ^ salt).view(np.int64))
            names.append(nodes[chosen[owner]])
            # Similar sets agree on all but d words; with more empty words than
            # spare ones, these may be the empty ones: sketch such a set again.
            todo = [i for i, e, s in zip(todo, empty, spare) if e > s]
        # What every sketch left in doubt is joined on its band alone.
        if todo:
            rest = np.array(todo)
            keys.append(mix64(band[rest].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64))
            names.append(nodes[rest])
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(names)


def bit_sketches(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parity of the n-grams that fall on each bit, as 64-bit integers end to end."""
    at = (mix64(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(BITS)).astype(np.int64)
    at += np.repeat(np.arange(len(sizes)) * BITS, sizes)
    parity = (np.bincount(at, minlength=len(sizes) * BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _members(n: int):
    @gives_back
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            nodes, counts = [], []
            for at in range(0, len(texts), BLOCK):
                value, sizes = ngram_sets(texts[at : at + BLOCK], n, words)
                nodes.append(_nodes(value, sizes))
                counts.append(sizes)
                if len(words) > REMEMBERED:
                    words.clear()
            empty = np.empty(0, np.int64)
            columns = list(batch.columns[:-1]) + [
                pa.array(np.concatenate(counts or [empty]), pa.int64()), pa.array(np.concatenate(nodes or [empty]), pa.int64())
            ]
            names = list(batch.schema.names[:-1]) + ["n_shingles", "node"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return members


_WORDS_SCHEMA = "bucket int, alone binary, met binary, passed binary"


def _blobs(bucket: np.ndarray, *columns: np.ndarray) -> pa.Array:
    """The bytes of the rows of each bucket; rows are sorted by ``bucket``."""
    data = np.ascontiguousarray(np.concatenate(columns, axis=1))
    ends = np.searchsorted(bucket, np.arange((1 << BUCKET_BITS) + 1)) * data.shape[1]
    return pa.Array.from_buffers(
        pa.binary(), 1 << BUCKET_BITS, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())]
    )


def _bytes(values: np.ndarray, width: int = 8) -> np.ndarray:
    """The low bytes of 64-bit integers, one row each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def _packed_words(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """The sketch words (key, node) of some texts by bucket of the key.

    Nodes that share a word within them are combined before the shuffle: the
    least one goes to the word's bucket, ``met`` if it has company and ``alone`` if not;
    the others are ``passed`` on as they are, to any bucket. Words keep the high bits of their key.
    """
    key = key.view(np.uint64) >> np.uint64(64 - BUCKET_BITS - WORD_BITS)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    head = np.ones(len(key), dtype=bool)
    head[1:] = key[1:] != key[:-1]
    company = head & np.r_[~head[1:], np.zeros(min(1, len(key)), dtype=bool)]
    bucket = (key >> np.uint64(WORD_BITS)).astype(np.int64)
    columns = [
        _blobs(bucket[kind], _bytes(key[kind], WORD_BITS // 8), _bytes(node[kind])) for kind in (head & ~company, company)
    ]
    key, node = key[~head], node[~head]
    anywhere = (mix64(key ^ mix64(node.view(np.uint64))) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    order = np.argsort(anywhere, kind="stable")
    columns.append(_blobs(anywhere[order], _bytes(key[order]), _bytes(node[order])))
    filled = sum(np.diff(np.frombuffer(x.buffers()[1], np.int32)) for x in columns)
    buckets = pa.array(np.arange(1 << BUCKET_BITS), pa.int32())
    return pa.RecordBatch.from_arrays([buckets, *columns], names=["bucket", "alone", "met", "passed"]).filter(pa.array(filled > 0))


def _keys(n: int, num: int, den: int):
    """The packed sketch words of texts, ``HELD_WORDS`` or somewhat more at a time."""

    @gives_back
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        bands = Bands(num, den)
        plan = bands.of(1)
        found_keys, found_nodes, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), BLOCK):
                value, sizes = ngram_sets(texts[at : at + BLOCK], n, words)
                largest = int(sizes.max(initial=1))
                if plan[-1][1] < largest:
                    plan = bands.of(largest)
                k, m = sketch_keys(value, sizes, _nodes(value, sizes), plan)
                found_keys.append(k)
                found_nodes.append(m)
                held += len(k)
                if len(words) > REMEMBERED:
                    words.clear()
                if held >= HELD_WORDS:
                    yield _packed_words(np.concatenate(found_keys), np.concatenate(found_nodes))
                    found_keys, found_nodes, held = found_keys[:1], found_nodes[:1], 0
        yield _packed_words(np.concatenate(found_keys), np.concatenate(found_nodes))

    return keys


def _rows_of(blobs: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all blobs, and how many each has."""
    found = blobs.to_pylist()
    counts = np.array([len(x) // width for x in found], dtype=np.int64)
    return np.frombuffer(b"".join(found), np.uint8).reshape(-1, width), counts


def _number(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data), 8), np.uint8)
    out[:, : data.shape[1]] = data
    return out.view(np.uint64).ravel()


def _shared(key: np.ndarray, node: np.ndarray, met: np.ndarray) -> pa.RecordBatch:
    """(key, node) of the words that several nodes have; ``met`` tells of company elsewhere."""
    order = np.lexsort((~met, node, key))
    key, node, met = key[order], node[order], met[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node, met = key[new], node[new], met[new]
    same = key[1:] == key[:-1]
    met[1:] |= same
    met[:-1] |= same
    return _pairs(key[met], node[met])


def _pairs(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64), pa.int64()), pa.array(node.view(np.int64), pa.int64())], names=["key", "node"]
    )


@gives_back
def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of the words that have company, from packed words in the order of their buckets.

    A bucket is looked at when the next one begins, so no more than one is held beyond ``HELD_WORDS``.
    """
    low = np.uint64(WORD_BITS)
    key, node, met = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool)
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy().astype(np.uint64)
        width = WORD_BITS // 8
        for i in (1, 2):
            data, counts = _rows_of(batch.column(i), width + 8)
            key = np.r_[key, (np.repeat(bucket, counts) << low) | _number(data[:, :width])]
            node = np.r_[node, _number(data[:, width:])]
            met = np.r_[met, np.full(len(data), i == 2)]
        data, _ = _rows_of(batch.column(3), 16)
        if len(data):
            yield _pairs(_number(data[:, :8]), _number(data[:, 8:]))
        if len(key) >= HELD_WORDS:
            over = (key >> low) < bucket[-1]
            if over.any():
                yield _shared(key[over], node[over], met[over])
                key, node, met = key[~over], node[~over], met[~over]
    yield _shared(key, node, met)


def _sets(n: int):
    @gives_back
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            nodes, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), BLOCK):
                value, sizes = ngram_sets(texts[at : at + BLOCK], n, words)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                grams = pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64)))
                bits = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1) * (BITS // 64), pa.int32()), pa.array(bit_sketches(value, sizes))
                )
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(at, len(sizes)), grams, bits], names=["node", "grams", "bits"]
                )
                if len(words) > REMEMBERED:
                    words.clear()

    return sets


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v, linked) of each pair, by the whole sets."""
    left = sets.select(F.col("node").alias("u"), F.col("grams").alias("gu"))
    right = sets.select(F.col("node").alias("v"), F.col("grams").alias("gv"))
    joined = pairs.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("gu", "gv"))
    union = F.size("gu") + F.size("gv") - F.col("common")
    return joined.withColumn("common", common).select(
        "u", "v", (F.col("common").cast("long") * den >= union.cast("long") * num).alias("linked")
    )


_COMPARED = ("node", "component", "size", "bits")


def _filter(rows: DataFrame) -> Column:
    """Whether the column ``row`` may be one of ``rows``; it is for all that are. ``rows`` is read twice."""
    once, _ = filters(rows.select("row"), bloom_bits(rows.count()))
    held = rows.sparkSession.sparkContext.broadcast(once)

    @F.pandas_udf("boolean")
    def among(names: pd.Series) -> pd.Series:
        return pd.Series(holds(held.value, hash_keys([x.encode() for x in names])))

    return among("row")


def _near(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different components that sizes and bit sketches cannot tell apart."""
    sizes = F.col("size_u") + F.col("size_v")
    alike = F.least("size_u", "size_v") * den >= F.greatest("size_u", "size_v") * num
    differing = F.aggregate(
        F.zip_with("bits_u", "bits_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y
    )
    close = differing * (den + num) <= sizes * (den - num)
    return pairs.where((F.col("component_u") != F.col("component_v")) & alike & close).withColumn(
        "differing", differing
    )


def link_nodes(docs: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(node, component) of the nodes that link with another one."""
    spark = docs.sparkSession
    words = docs.select("text").mapInArrow(_keys(n, num, den), _WORDS_SCHEMA)
    ordered = words.repartition("bucket").sortWithinPartitions("bucket")
    groups = stage(ordered.mapInArrow(_company, "key long, node long").distinct(), "groups")
    # One document of each node that shares a word lends its text.
    one = members.join(groups.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min("row").alias("row")
    )
    one = stage(one, "lenders")
    # Of equal rows one is kept in each task; texts, not their larger sets, are then shuffled once.
    texts = docs.select(row_key("doc_id", "text").alias("row"), "text").where(_filter(one)).dropDuplicates(["row"])
    lent = texts.join(one, "row").select("node", "text")
    sets = stage(
        lent.mapInArrow(_sets(n), "node long, grams array<long>, bits array<long>").withColumn("size", F.size("grams")),
        "sets",
    )
    known, tables = spark.createDataFrame([], "u long, v long, linked boolean"), []
    found = spark.createDataFrame([], "node long, component long")
    for turn in range(STAR_ROUNDS + 1):
        here = groups.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        here = stage(here, "here")
        split = here.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        live = here.join(split.where("low <> high").select("key"), "key", "left_semi")
        drawn = sets.select("node", "size", "bits")
        if turn < STAR_ROUNDS:
            # One member of each group, another one in every round.
            first = F.min(F.struct(F.xxhash64(F.lit(turn), "node"), "node", "component")).alias("hub")
            hubs = live.groupBy("key").agg(first).select("key", F.col("hub.node").alias("node_v"), F.col("hub.component").alias("component_v"))
            met = live.join(hubs, "key").where("component <> component_v").select(
                F.col("node").alias("node_u"), "node_v", F.col("component").alias("component_u"), "component_v",
                F.least("node", "node_v").alias("u"), F.greatest("node", "node_v").alias("v"),
            )
            met = met.distinct().join(known, ["u", "v"], "left_anti")
            for side in ("v", "u"):
                met = met.join(drawn.select(*(F.col(c).alias(f"{c}_{side}") for c in drawn.columns)), f"node_{side}")
            best = _near(met, num, den).groupBy("node_u").agg(F.min(F.struct("differing", "u", "v")).alias("best"))
            pairs = best.select("best.u", "best.v").distinct()
        else:
            live = live.join(drawn, "node")
            a = live.select("key", *(F.col(c).alias(f"{c}_u") for c in _COMPARED))
            b = live.select("key", *(F.col(c).alias(f"{c}_v") for c in _COMPARED))
            both = a.join(b, "key").where(F.col("node_u") < F.col("node_v"))
            pairs = _near(both, num, den).select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct()
        pairs = stage(pairs.join(known, ["u", "v"], "left_anti"), "pairs")
        checked = stage(_verified(pairs, sets, num, den), "checked")
        discard(here, pairs)
        known = known.unionByName(checked)
        tables.append(checked)
        if checked.where("linked").isEmpty():
            continue
        before, found = found, components(known.where("linked").select("u", "v"))
        discard(before)
    discard(groups, one, sets, *tables)
    return found


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """row, doc_id, n_shingles, node and component_id of each document.

    Sets link when ``den * intersection >= num * union``; component_id is the
    smallest doc_id that can be reached by links. ``docs`` is read several times; the
    result is stored.
    """
    small_batches(docs.sparkSession, 500)
    slim = docs.select(row_key("doc_id", "text").alias("row"), "doc_id", "text")
    schema = slim.select("row", "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.lit(0).cast("long").alias("node")).schema
    members = stage(slim.mapInArrow(_members(n), schema), "members")
    full = members.where("n_shingles > 0")
    found = link_nodes(docs, full, n, num, den)
    least = full.groupBy("node").agg(F.min("doc_id").alias("least")).join(found, "node", "left")
    least = stage(least.withColumn("component", F.coalesce("component", "node")), "least")
    names = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = least.join(names, "component").select("node", "component_id")
    named = full.join(by_node, "node", "left").select("row", "doc_id", "n_shingles", "node", "component_id")
    empty = members.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    placed = stage(named.unionByName(empty.select("row", "doc_id", "n_shingles", "node", "component_id")), "placed")
    discard(members, least, found)
    return placed


def link_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""
    return join(docs, n, num, den).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Documents without words are kept. Of repeated rows one stays.
    """
    placed = join(docs, n, num, den)
    full = placed.where("n_shingles > 0")
    best = full.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("s"), F.count("*").alias("n"))
    best = stage(best, "best")
    stays = best.select("s.row")
    # Rows alone in their component stay without a shuffle.
    several = best.where("n > 1").select(F.col("component_id").alias("of"))
    doubtful = full.join(several, F.col("component_id").eqNullSafe(F.col("of")), "left_semi")
    rows = docs.select(
        packed(docs), row_key("doc_id", "text").alias("row"),
        (F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(0)) == 0).alias("wordless"),
    )
    rows = rows.withColumn("among", ~F.col("wordless") & _filter(doubtful))
    # Of equal rows one is kept in each task before they meet.
    one = Window.partitionBy("row").orderBy("row")
    first = rows.where("among").withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    return unpacked(first.join(stays, "row", "left_semi").unionByName(rows.where("NOT among")), docs)
