"""Audit of how far the sources of a language differ in their words.

The counts of a language's kept terms are a matrix, a row for each source (group)
and a column for each term. It is cut into square tiles, and a tile with a count
in it is held as a K2 quadtree (K = 2): a bit for each quadrant of a node that is
not all zero, level by level, and the counts of the leaves in the same order.

The divergence of a pair of groups is a sum over all kept terms, and most cells
are zero. All arithmetic is on integers, so the sum may be taken apart exactly.
With p(g, t) the scaled share of a term in a group, z(g) that of an absent term and
f the divergence of two shares:

    value(g, h) = V f(z(g), z(h))                                    all-zero quadrants
        + sum over terms t of g: f(p(g, t), z(h)) - f(z(g), z(h))    and the same of h
        + sum over terms of both: f(p(g, t), p(h, t)) - f(p(g, t), z(h))
                                  - f(z(g), p(h, t)) + f(z(g), z(h))

The first line prices what is zero in both without visiting it. The second needs
only how often each count occurs in a group. The third is found by walking the
quadtrees of two tiles of the same terms jointly, down to the leaves that both
hold; a quadrant that is empty in either tree ends the walk there.

Terms are counted in tasks before they are shuffled, keyed by language, source and
term, so a hot source is combined where it lies. A pair of tiles is a bounded unit
of work: ``SIDE`` groups by ``SIDE`` groups by ``SIDE`` terms.

Cases: null text, lang and source are ''; rows are documents of their own, so
repeated rows count again and doc_id is not read; a group without terms takes part;
a language without kept terms gives pairs of value 0 and no terms; a language with
one source gives no pairs; an empty table gives no rows; other columns are dropped.
Totals of up to 9 * 10**15 words a language are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import small_batches
from ledgerlint.sources.staging import stage

SCALE = 1_000_000_000
#: Groups and terms of a tile: a power of two.
SIDE = 128
#: Distinct terms of all groups a task holds, after a batch, before it passes them on.
HELD = 300_000
#: Bytes of a text whose terms are listed at a time.
LONG = 1 << 20
#: Groups that are few enough to be sent to all tasks, at about a hundred bytes each.
FEW = 50_000
#: Cells priced at a time.
PRICED = 1 << 20

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_COUNTS = "lang string, source string, term string, n long, docs long"


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in lists of a bounded length, cut between terms."""
    at = 0
    while len(text) - at > LONG:
        end = at + LONG
        last = _BREAK.search(text, end)
        end = last.start() if last else len(text)
        yield _TERM.findall(text, at, end)
        at = end
    yield _TERM.findall(text, at)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term of each group, and documents that hold it."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            distinct: set[bytes] = set()
            for words in _words(text.encode().lower()):
                n.update(words)
                distinct.update(words)
            docs.update(distinct)
        if sum(len(n) for n, _ in held.values()) >= HELD:
            yield from _batches(held)
            held = {}
    yield from _batches(held)


def _batches(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        terms = list(n)
        for start in range(0, len(terms), 10_000):
            part = terms[start : start + 10_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.repeat(pa.scalar(lang, pa.string()), len(part)),
                    "source": pa.repeat(pa.scalar(source, pa.string()), len(part)),
                    "term": pa.array(part, pa.binary()).cast(pa.string()),
                    "n": pa.array([n[t] for t in part], pa.int64()),
                    "docs": pa.array([docs[t] for t in part], pa.int64()),
                }
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it) of each group."""
    small_batches(docs.sparkSession)
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = read.mapInArrow(_counted, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / size)."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.call_function("div", scaled, size.cast("decimal(18,0)"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)) of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same for arrays: a long division, three decimal digits at a time."""
    left, out = counts + 2, np.zeros(np.broadcast(counts, sizes).shape, dtype=np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // sizes
        left = left % sizes
    return out + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Quadtree:
    """A tile of counts; cells are (row, column, count) with a count above zero.

    ``levels`` has a byte for each node, level by level from the root: bit
    2 * (lower half) + (right half) is set for each quadrant that is not all zero.
    ``counts`` are those of the leaves, in the order of the last level's bits.
    """

    def __init__(self, levels: list[np.ndarray], counts: np.ndarray):
        self.levels, self.counts = levels, counts

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> Quadtree:
        depth = SIDE.bit_length() - 1
        place = np.zeros(len(rows), dtype=np.int64)
        for bit in range(depth):
            place |= (((rows >> bit) & 1) << (2 * bit + 1)) | (((columns >> bit) & 1) << (2 * bit))
        order = np.argsort(place, kind="stable")
        place, levels = place[order], []
        for level in range(depth):
            below = np.unique(place >> (2 * (depth - level - 1)))
            nodes, owner = np.unique(below >> 2, return_inverse=True)
            bits = np.zeros(len(nodes), dtype=np.uint8)
            np.bitwise_or.at(bits, owner, np.left_shift(1, below & 3).astype(np.uint8))
            levels.append(bits)
        return cls(levels, counts[order])

    def packed(self) -> tuple[bytes, list[int], bytes]:
        """Levels end to end, their lengths, and the counts."""
        return np.concatenate(self.levels).tobytes(), [len(x) for x in self.levels], self.counts.astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, levels: bytes, lengths: list[int], counts: bytes) -> Quadtree:
        cuts = np.cumsum(lengths)[:-1]
        return cls(np.split(np.frombuffer(levels, np.uint8), cuts), np.frombuffer(counts, "<i8"))

    def children(self, level: int) -> np.ndarray:
        """Position in the next level of each node's quadrants, -1 for those all zero."""
        held = (self.levels[level][:, None] >> np.arange(4, dtype=np.uint8)) & 1 == 1
        return np.where(held, np.cumsum(held.ravel()).reshape(-1, 4) - 1, -1)


def walk(a: Quadtree, b: Quadtree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves in one column: row and leaf in ``a``, row and leaf in ``b``."""
    row_a = row_b = np.zeros(1, dtype=np.int16)
    at_a = at_b = np.zeros(1, dtype=np.int32)
    for level in range(len(a.levels)):
        under_a, under_b = (tree.children(level).astype(np.int32) for tree in (a, b))
        found = []
        for upper in range(8):
            ra, rb, column = upper >> 2, (upper >> 1) & 1, upper & 1
            x, y = under_a[at_a, 2 * ra + column], under_b[at_b, 2 * rb + column]
            both = (x >= 0) & (y >= 0)
            found.append((2 * row_a[both] + ra, x[both], 2 * row_b[both] + rb, y[both]))
        row_a, at_a, row_b, at_b = (np.concatenate(part) for part in zip(*found))
    return row_a, at_a, row_b, at_b


def shared_terms(a: Quadtree, b: Quadtree, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Third line of the sum for each group of tile ``a`` with each of tile ``b``."""
    out = np.zeros((len(sizes_a), len(sizes_b)), dtype=np.int64)
    row_a, at_a, row_b, at_b = walk(a, b)
    # Shares of the leaves met, and of an absent term in each group.
    size_a, size_b = np.ones_like(a.counts), np.ones_like(b.counts)
    size_a[at_a], size_b[at_b] = sizes_a[row_a], sizes_b[row_b]
    p, q = shares(a.counts, size_a), shares(b.counts, size_b)
    nothing = np.zeros(1, dtype=np.int64)
    z, y = shares(nothing, sizes_a), shares(nothing, sizes_b)
    absent = divergences(z[:, None], y[None, :])
    for start in range(0, len(row_a), PRICED):
        part = slice(start, start + PRICED)
        g, h, ps, qs = row_a[part], row_b[part], p[at_a[part]], q[at_b[part]]
        np.add.at(out, (g, h), divergences(ps, qs) - divergences(ps, y[h]) - divergences(z[g], qs) + absent[g, h])
    return out


_TILE = "lang string, tile long, block long, levels binary, lengths array<int>, counts binary"
_TILE_FIELDS = pa.schema(
    [("lang", pa.string()), ("tile", pa.int64()), ("block", pa.int64()), ("levels", pa.binary()),
     ("lengths", pa.list_(pa.int32())), ("counts", pa.binary())]
)
_PRICED = "lang string, block long, row int, other long, other_row int, value long"


def _tile(key: tuple, cells: pa.Table) -> pa.Table:
    tree = Quadtree.build(*(cells.column(c).to_numpy().astype(np.int64) for c in ("row", "col", "n")))
    levels, lengths, counts = tree.packed()
    names = {name: [value.as_py()] for name, value in zip(("lang", "tile", "block"), key)}
    return pa.table({**names, "levels": [levels], "lengths": [lengths], "counts": [counts]}, schema=_TILE_FIELDS)


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over shared terms of all pairs of groups in a pair of tiles."""
    for batch in batches:
        for i in range(batch.num_rows):
            unit = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            a = Quadtree.unpacked(unit["levels"], unit["lengths"], unit["counts"])
            b = Quadtree.unpacked(unit["other_levels"], unit["other_lengths"], unit["other_counts"])
            value = shared_terms(a, b, np.array(unit["sizes"], np.int64), np.array(unit["other_sizes"], np.int64))
            if unit["block"] == unit["other"]:
                value = np.triu(value, 1)
            row, other_row = np.nonzero(value)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.repeat(pa.scalar(unit["lang"], pa.string()), len(row)),
                    "block": pa.repeat(pa.scalar(unit["block"], pa.int64()), len(row)),
                    "row": pa.array(row, pa.int32()),
                    "other": pa.repeat(pa.scalar(unit["other"], pa.int64()), len(row)),
                    "other_row": pa.array(other_row, pa.int32()),
                    "value": pa.array(value[row, other_row], pa.int64()),
                }
            )


def _numbered(items: DataFrame, many: int, name: str, block: str, place: str) -> DataFrame:
    """Items of a language dealt into blocks of ``SIDE``, with their place in the block.

    Numbers run within parts of about 4,096 of all ``many`` items, so that no task
    orders a language.
    """
    parts = max(1, -(-many // 4096))
    rank = F.row_number().over(Window.partitionBy("lang", "part").orderBy(name)) - 1
    placed = items.withColumn("part", F.pmod(F.xxhash64(F.lit(17), name), F.lit(parts))).withColumn("at", rank)
    return placed.withColumn(
        block, (F.col("part") * (1 << 20) + F.floor(F.col("at") / SIDE)).cast("long")
    ).withColumn(place, F.col("at") % SIDE).drop("part", "at")


def _beside_groups(cells: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """Cells with what is known of their group; few groups are sent to the cells."""
    return cells.join(F.broadcast(groups) if few else groups, ["lang", "source"])


def _priced_alone(cells: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """First and second line of the sum, as lang, source, item and value."""
    often = cells.groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
    # A language's rows meet its groups in parts, which grow with the groups.
    salts = groups.groupBy("lang").agg((F.lit(8) + F.floor(F.count("*") / 16)).cast("int").alias("salts"))
    sized = groups.join(salts, "lang")
    left = _beside_groups(often, sized.select("lang", "source", "size", "salts"), few).select(
        "lang", "source", "salts", "times", share(F.col("n"), F.col("size")).alias("p"),
        share(F.lit(0).cast("long"), F.col("size")).alias("z"),
    )
    empty = sized.select(
        "lang", "source", "salts", F.col("kept").alias("times"), F.lit(None).cast("long").alias("p"),
        share(F.lit(0).cast("long"), F.col("size")).alias("z"),
    )
    left = left.unionByName(empty).withColumn("salt", F.pmod(F.xxhash64("source", "p"), "salts").cast("int"))
    right = sized.select(
        "lang", F.col("source").alias("item"), share(F.lit(0).cast("long"), F.col("size")).alias("y"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    both = left.join(right, ["lang", "salt"]).where(F.col("source") != F.col("item"))
    absent = divergence(F.col("z"), F.col("y"))
    value = F.when(F.col("p").isNotNull(), divergence(F.col("p"), F.col("y")) - absent).otherwise(
        F.when(F.col("source") < F.col("item"), absent).otherwise(F.lit(0).cast("long"))
    )
    return both.select("lang", "source", "item", (value * F.col("times")).alias("value"))


def _priced_jointly(cells: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """Third line of the sum, each pair of groups once."""
    named = _beside_groups(cells, groups.select("lang", "source", "block", "row"), few)
    tiles = stage(
        named.select("lang", "tile", "block", "row", "col", "n").groupBy("lang", "tile", "block")
        .applyInArrow(_tile, _TILE),
        "tiles",
    )
    # Sizes by place; a block has SIDE groups at most.
    sizes = groups.groupBy("lang", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row", "size"))), lambda x: x["size"]).alias("sizes")
    )
    held = tiles.join(sizes, ["lang", "block"])
    others = held.select(
        "lang", "tile", *(F.col(c).alias("other" if c == "block" else f"other_{c}")
                          for c in ("block", "levels", "lengths", "counts", "sizes"))
    )
    units = held.join(others, ["lang", "tile"]).where(F.col("block") <= F.col("other"))
    found = units.mapInArrow(_joint, _PRICED).groupBy("lang", "block", "row", "other", "other_row").agg(
        F.sum("value").alias("value")
    )
    names = groups.select("lang", "block", "row", "source")
    second = names.select("lang", F.col("block").alias("other"), F.col("row").alias("other_row"),
                          F.col("source").alias("item"))
    return found.join(names, ["lang", "block", "row"]).join(second, ["lang", "other", "other_row"]).select(
        "lang", "source", "item", "value"
    )


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value and rank: pairs of sources, and telling terms of each source."""
    counts = stage(term_counts(docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
    kept = stage(kept.where(F.col("docs") >= min_docs).select("lang", "term", "all_n"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("all_words"))
    placed = _numbered(kept, kept.count(), "term", "tile", "col")
    cells = stage(counts.drop("docs").join(placed, ["lang", "term"]), "cells")

    seen = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    seen = stage(seen.distinct(), "sources")
    many = seen.count()
    words = cells.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    size = F.greatest(F.coalesce("words", F.lit(0)) + 2 * F.col("kept"), F.lit(1)).cast("long")
    groups = _numbered(seen, many, "source", "block", "row").join(words, ["lang", "source"], "left").join(
        langs, "lang", "left"
    ).withColumn("kept", F.coalesce("kept", F.lit(0)).cast("long")).withColumn("size", size)
    all_size = (F.col("all_words") + 2 * F.col("kept")).alias("all_size")
    groups = stage(groups.select("lang", "source", "block", "row", "kept", "size", all_size), "groups")
    few = many <= FEW

    parts = _priced_alone(cells, groups, few).unionByName(_priced_jointly(cells, groups, few))
    pairs = parts.groupBy(
        "lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b")
    ).agg(F.sum("value").alias("value"))
    ends = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")))
    pairs = pairs.select("lang", F.inline(ends), "value", F.lit("pair").alias("part"))

    told = _beside_groups(cells, groups.select("lang", "source", "size", "all_size"), few).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("size")).alias("p"),
        share(F.col("all_n"), F.col("all_size")).alias("q"),
    ).where("p > q")
    terms = told.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"),
                        F.lit("term").alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    ranked = pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
