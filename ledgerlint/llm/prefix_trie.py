"""Prefix trie of conversations: a z-fast trie, filled in batches.

Every conversation is rebuilt from the first turns of the one it continues and its
own later turns. A turn is a symbol of 124 bits, and the first d turns have a hash
that is a polynomial in the symbols, so that the hash of a rebuilt prefix follows
from those of its two parts. Texts are read once and never shuffled.

The trie is a table of compacted nodes. A node stands for the depths (lo, hi] of the
string that made it, and is found by its handle: the prefix at the two-fattest
depth of that interval, the one divisible by the highest power of two.

* **Locate.** Fat binary search halves the depths at which a conversation can leave
  the trie: it looks up the prefix at the two-fattest depth of what is left, and goes
  on below the node found, or above. The node where it leaves is the last one found,
  or that one's child by the next turn; the depth is that of the last equal prefix.
* **Insert in batches.** Of the conversations that leave at one place by the same
  turn, one is inserted; edges are split at every depth where a conversation leaves
  or ends. The others are located again. Conversations that share a first turn are
  so dealt over the trie in about as many rounds as the logarithm of their number.
* **Sums.** A node's figures are sums over its subtree. They rise by pointer
  doubling: each node adds its sums to its 2^i-th ancestor, where they combine
  before the shuffle. Words count by prefix sums: those of all members, and those of
  all distinct turns, each minus what lies above.
* **Expand.** In the end each edge yields a node for each of its depths.

Equal conversations are one string with a count. Turns are numbered, and their
hashes run, over range partitions; what a partition begins with is carried over,
so no conversation must fit in one task.

Cases: turns are ordered by turn, null first, then by the MD5 of role and text;
null role or text is empty; rows without conv_id take no part; repeated rows are
turns of their own; an empty table has no nodes, not even a root; other columns
are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.mixing import words_in
from ledgerlint.sources.staging import discard, stage

#: Moduli and bases of the four polynomials (primes below 2 ** 31).
MODULI = np.array([2147483647, 2147483629, 2147483587, 2147483579], dtype=np.int64)
BASES = np.array([1268511349, 1779033703, 1013904242, 1597334677], dtype=np.int64)
LANES = 4
#: Conversations that continue one, and turns taken from it at most.
FAMILY = 20
SHARED = 4
#: Ids joined into one text before they are hashed.
JOINED = 4096
EMPTY = hashlib.sha256().hexdigest()


def _lanes(column: pa.Array) -> np.ndarray:
    """Hashes as rows of four integers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, LANES).astype(np.int64)


def _binary(lanes: np.ndarray, depths: np.ndarray | None = None) -> pa.Array:
    """Hashes as 16 bytes each, after 8 bytes of the depth if it is given."""
    data = np.ascontiguousarray(lanes.astype("<u4")).view(np.uint8).reshape(len(lanes), 4 * LANES)
    if depths is not None:
        data = np.hstack([depths.astype(">i8").view(np.uint8).reshape(len(lanes), 8), data])
    width = data.shape[1]
    whole = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(data), [None, pa.py_buffer(data.tobytes())])
    return whole.cast(pa.binary())


def powers(exponents: np.ndarray) -> np.ndarray:
    """BASES ** exponent, modulo MODULI, a row for each exponent."""
    out = np.ones((len(exponents), LANES), dtype=np.int64)
    square, left = BASES.copy(), exponents.astype(np.int64)
    while left.any():
        odd = (left & 1 == 1)[:, None]
        out = np.where(odd, out * square % MODULI, out)
        square, left = square * square % MODULI, left >> 1
    return out


_INVERSE = np.array([pow(int(b), -1, int(m)) for b, m in zip(BASES, MODULI)], dtype=np.int64)


def running(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of sequences that lie end to end.

    ``starts`` has, for each symbol, the position at which its sequence begins.
    """
    n = len(symbols)
    up, down = np.empty((n + 1, LANES), np.int64), np.empty((n + 1, LANES), np.int64)
    up[0] = down[0] = 1
    size = 1
    while size <= n:  # powers by doubling
        take = min(size, n + 1 - size)
        up[size : size + take] = up[:take] * (up[size - 1] * BASES % MODULI) % MODULI
        down[size : size + take] = down[:take] * (down[size - 1] * _INVERSE % MODULI) % MODULI
        size += take
    sums = np.zeros((n + 1, LANES), np.int64)
    sums[1:] = np.cumsum(symbols % MODULI * down[:n] % MODULI, axis=0) % MODULI
    return (sums[1:] - sums[starts]) % MODULI * up[:n] % MODULI


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position, hash and words up to each turn; counted from the start of the partition."""
    last, position, words, head = None, 0, 0, np.zeros((1, LANES), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        change = np.r_[True, conv[1:] != conv[:-1]]
        starts = np.maximum.accumulate(np.where(change, np.arange(len(conv)), 0))
        positions = np.arange(len(conv)) - starts + 1
        hashes = running(_lanes(batch.column("symbol")), starts)
        total = np.cumsum(batch.column("words").to_numpy())
        total = total - np.where(starts > 0, total[starts - 1], 0)
        first = starts == 0
        if conv[0] == last:  # the sequence goes on from the batch before
            hashes[first] = (hashes[first] + head * powers(positions[first])) % MODULI
            positions, total = positions + first * position, total + first * words
        last, position, words, head = conv[-1], int(positions[-1]), int(total[-1]), hashes[-1:]
        yield pa.RecordBatch.from_pydict(
            {
                "part": batch.column("part"), "conv_id": batch.column("conv_id"),
                "position": pa.array(positions, pa.int64()), "hash": _binary(hashes),
                "total": pa.array(total, pa.int64()),
            }
        )


_PREFIXES = "part int, conv_id long, position long, hash binary, total long"


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes after what goes before them: ``before_hash``, minus ``less_hash`` of the part left out.

    A row has ``step``, its turns after the join.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        gone = (_lanes(batch.column("before_hash")) - _lanes(batch.column("less_hash"))) % MODULI
        hashes = (_lanes(batch.column("hash")) + gone * powers(batch.column("step").to_numpy())) % MODULI
        depths = batch.column("depth").to_numpy()
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"), "depth": batch.column("depth"),
                "hash": _binary(hashes), "key": _binary(hashes, depths), "total": batch.column("total"),
                "ends": batch.column("ends"),
            }
        )


_SHIFTED = "conv_id long, depth long, hash binary, key binary, total long, ends boolean"


def _nothing() -> Column:
    """The hash of no turns."""
    return F.lit(bytes(4 * LANES))


def _root() -> Column:
    """The key of no turns."""
    return F.lit(bytes(8 + 4 * LANES))


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, position, hash and total (words) of the first turns of each conversation."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    symbol = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        symbol.alias("symbol"), words_in(text).alias("words"),
    )
    # The order holds rows of a hot conversation apart; equal rows may lie in any order.
    rows = stage(turns, "turns")
    ordered = rows.repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id", "turn", "symbol"
    ).withColumn("part", F.spark_partition_id()).sortWithinPartitions("conv_id", "turn", "symbol")
    local = stage(ordered.mapInArrow(_prefixes, _PREFIXES), "prefixes")
    # A conversation in several parts: what the parts before hold of it, one row for each part.
    spread = local.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    cut = local.join(spread.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id", "part").agg(
        F.max("position").alias("inside")
    )
    tails = local.withColumnRenamed("position", "inside").join(cut, ["conv_id", "part", "inside"]).select(
        "conv_id", "part", "inside", "hash", "total"
    )
    carried = tails.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "inside", "hash", "total"))).alias("tails")
    )
    before = carried.mapInPandas(_carry, "conv_id long, part int, n long, before_hash binary, before_total long")
    before = stage(before, "carried")
    joined = local.join(before, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("position") + F.coalesce("n", F.lit(0))).alias("depth"), "hash",
        (F.col("total") + F.coalesce("before_total", F.lit(0))).alias("total"),
        F.coalesce("before_hash", _nothing()).alias("before_hash"), _nothing().alias("less_hash"),
        F.col("position").alias("step"), F.lit(False).alias("ends"),
    )
    shifted = joined.mapInArrow(_shifted, _SHIFTED)
    whole = stage(shifted.select("conv_id", F.col("depth").alias("position"), "hash", "total"), "turn-prefixes")
    discard(rows, local, before)
    return whole


def _carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each part of a conversation, the count, hash and words of the parts before."""
    for batch in batches:
        rows = []
        for conv, tails in zip(batch["conv_id"], batch["tails"]):
            n, words, head = 0, 0, np.zeros((1, LANES), np.int64)
            for tail in tails:
                rows.append((conv, tail["part"], n, head.astype("<u4").tobytes(), words))
                own = np.frombuffer(tail["hash"], "<u4").astype(np.int64)[None, :]
                head = (own + head * powers(np.array([tail["inside"]]))) % MODULI
                n, words = n + tail["inside"], words + tail["total"]
        yield pd.DataFrame(rows, columns=["conv_id", "part", "n", "before_hash", "before_total"])


def rebuilt(prefixes: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """conv_id, depth, key and total of all prefixes of the rebuilt conversations.

    The first h turns come from conversation c - c % family, where h is the crc32
    of c as text modulo ``shared``; own turns follow after the first h. ``ends``
    marks a conversation's last prefix; a conversation without turns has a row of depth 0.
    """
    own = prefixes.groupBy("conv_id").agg(F.max("position").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % shared
    own = own.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    # The first turns of each conversation, fewer than ``shared``.
    heads = prefixes.where(F.col("position") < shared)
    taken = own.where("h > 0").join(heads.withColumnRenamed("conv_id", "base"), "base").where("position <= h")
    # Bounded: fewer than ``shared`` rows for each conversation.
    best = taken.groupBy("conv_id").agg(
        F.max_by(F.struct("position", "hash", "total"), "position").alias("b")
    )
    skipped = own.where("h > 0").join(heads, "conv_id").where("position = h").select(
        "conv_id", F.struct("hash", "total").alias("s")
    )
    joints = stage(
        own.join(best, "conv_id", "left").join(skipped, "conv_id", "left").select(
            "conv_id", "h", "n", F.coalesce("b.position", F.lit(0)).cast("long").alias("start"),
            F.coalesce("b.hash", _nothing()).alias("before_hash"), F.coalesce("b.total", F.lit(0)).alias("before_total"),
            F.coalesce("s.hash", _nothing()).alias("less_hash"), F.coalesce("s.total", F.lit(0)).alias("less_total"),
        ),
        "joints",
    )
    step = F.col("position") - F.col("h")
    later = prefixes.join(joints, "conv_id").where("position > h").select(
        "conv_id", (F.col("start") + step).alias("depth"), "hash",
        (F.col("total") + F.col("before_total") - F.col("less_total")).alias("total"),
        "before_hash", "less_hash", step.alias("step"), (F.col("position") == F.col("n")).alias("ends"),
    )
    from_base = taken.join(joints.select("conv_id", "start"), "conv_id").select(
        "conv_id", F.col("position").alias("depth"), "hash", "total", _nothing().alias("before_hash"),
        _nothing().alias("less_hash"), F.col("position").alias("step"),
        ((F.col("position") == F.col("start")) & (F.col("n") <= F.col("h"))).alias("ends"),
    )
    turnless = joints.where("start = 0 AND n <= h").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), _nothing().alias("hash"), F.lit(0).cast("long").alias("total"),
        _nothing().alias("before_hash"), _nothing().alias("less_hash"), F.lit(0).cast("long").alias("step"),
        F.lit(True).alias("ends"),
    )
    rows = later.unionByName(from_base).unionByName(turnless).mapInArrow(_shifted, _SHIFTED)
    whole = stage(rows.drop("hash"), "rebuilt")
    discard(prefixes, joints)
    return whole


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    return F.call_function("shiftleft", F.call_function("shiftright", high, _top_bit(low, high)), _top_bit(low, high))


def _top_bit(low: Column, high: Column) -> Column:
    return F.length(F.bin(low.bitwiseXOR(high))) - 1


def _dressed(nodes: DataFrame, strings: DataFrame) -> DataFrame:
    """Keys of nodes (name, lo, hi): handle, first, last and up, with words at both ends."""
    lo, hi = F.col("lo"), F.col("hi")
    wanted = nodes.where("lo < hi").select(
        "name", "lo", "hi", F.explode(F.array_distinct(F.array(two_fattest(lo, hi), lo, lo + 1, hi))).alias("depth")
    )
    found = wanted.join(strings, ["name", "depth"], "left")
    depth, key = F.col("depth"), F.col("key")

    def at(place: Column, value: Column) -> Column:
        return F.max(F.when(depth == place, value))

    return found.groupBy("name", "lo", "hi").agg(
        at(two_fattest(lo, hi), key).alias("handle"), at(lo + 1, key).alias("first"), at(hi, key).alias("last"),
        F.coalesce(at(lo, key), _root()).alias("up"), F.coalesce(at(lo, F.col("total")), F.lit(0)).alias("words_lo"),
        at(hi, F.col("total")).alias("words_hi"),
    )


def located(pending: DataFrame, trie: DataFrame, strings: DataFrame, steps: int) -> DataFrame:
    """Where each pending string leaves the trie.

    ``name, length, depth`` (of the last equal prefix), ``leaf_key`` (its next
    prefix, null if it ends there), and the edge: ``edge`` (last key), ``edge_hi``.
    """
    mine = strings.join(pending.select("name"), "name", "left_semi")
    node = F.struct("name", "lo", "hi", "last")
    handles = trie.where("hi > 0").select(F.col("handle").alias("key"), node.alias("node"))
    # What each prefix finds in the hash table of handles; the search looks at few of them.
    table = stage(mine.join(handles, "key", "left").select("name", "depth", "key", "next", "node"), "handles")
    probe = table.select("name", "depth", "node")
    root = F.struct(
        F.lit(None).cast("long").alias("name"), F.lit(-1).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"),
        _root().alias("last"),
    )
    state = pending.select("name", "length", F.lit(0).cast("long").alias("a"), F.col("length").alias("b"),
                           root.alias("found"))
    for _ in range(steps):
        open_one = F.col("a") < F.col("b")
        state = state.withColumn("depth", F.when(open_one, two_fattest(F.col("a"), F.col("b"))))
        state = state.join(probe, ["name", "depth"], "left")
        hit = F.col("node").isNotNull()
        state = state.select(
            "name", "length", F.when(hit, F.col("node.hi")).otherwise(F.col("a")).alias("a"),
            F.when(open_one & ~hit, F.col("depth") - 1).otherwise(F.col("b")).alias("b"),
            F.when(hit, F.col("node")).otherwise(F.col("found")).alias("found"),
        )
    # Does the string hold the whole of the node found? Then it goes on to a child, or leaves there.
    here = table.select("name", F.col("depth").alias("hi"), "key", "next")
    holds = F.coalesce(F.col("key") == F.col("found.last"), F.lit(False))
    state = state.withColumn("hi", F.col("found.hi")).join(here, ["name", "hi"], "left").select(
        "name", "length", "hi", "found", holds.alias("holds"), F.when(holds, F.col("next")).alias("first")
    )
    found = stage(state, "found")
    firsts = trie.where("hi > 0").select("first", node.alias("child"))
    edge = F.when(~F.col("holds"), F.col("found")).otherwise(F.col("child"))
    state = found.join(firsts, "first", "left").select("name", "length", F.col("hi").alias("base"), edge.alias("edge"))
    # The last depth at which string and edge are equal.
    on = state.where("edge IS NOT NULL").select("name", F.col("edge.name").alias("rep"), F.col("edge.lo").alias("lo"),
                                                F.col("edge.hi").alias("hi"))
    both = on.join(table.select("name", "depth", "key"), "name").where("depth > lo AND depth <= hi")
    theirs = strings.select(F.col("name").alias("rep"), "key")
    equal = both.select("name", "rep", "depth", "key").join(theirs, ["rep", "key"]).groupBy("name").agg(
        F.max("depth").alias("equal")
    )
    state = state.join(equal, "name", "left").select(
        "name", "length", F.coalesce("equal", "base").alias("depth"), F.col("edge.last").alias("edge"),
        F.col("edge.hi").alias("edge_hi"),
    )
    leaf = table.select("name", "depth", F.col("next").alias("leaf_key"))
    exits = stage(state.join(leaf, ["name", "depth"], "left"), "exits")
    discard(table, found)
    return exits


def build(strings: DataFrame, ends: DataFrame) -> DataFrame:
    """The trie of all strings: name, lo, hi, handle, first, last, up and words of each compacted node.

    ``strings`` has name, depth, key, next (key) and total of every prefix, the empty
    one included; ``ends`` has name and length of every string.
    """
    spark = strings.sparkSession
    longest = ends.agg(F.max("length")).first()[0] or 0
    steps = int(longest).bit_length()
    trie = spark.range(1).select(
        F.lit(None).cast("long").alias("name"), F.lit(-1).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"),
        F.lit(None).cast("binary").alias("handle"), F.lit(None).cast("binary").alias("first"), _root().alias("last"),
        F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("words_lo"),
        F.lit(0).cast("long").alias("words_hi"),
    )
    trie = stage(trie, "trie")
    pending = stage(ends.where("length > 0").select("name", "length"), "pending")
    while not pending.isEmpty():
        exits = located(pending, trie, strings, steps)
        order = F.struct(F.xxhash64("name"), "name")
        chosen = exits.where("leaf_key IS NOT NULL").groupBy("leaf_key").agg(F.min_by("name", order).alias("name"))
        chosen = stage(chosen.join(exits.select("name", "depth", "length"), "name"), "chosen")
        leaves = chosen.select("name", F.col("depth").alias("lo"), F.col("length").alias("hi"))
        # Edges end where a string leaves them, or ends inside.
        cuts = exits.where("edge IS NOT NULL AND depth < edge_hi").select(F.col("edge").alias("last"), "depth").distinct()
        split = stage(trie.select("last", "name", "lo", "hi").join(cuts, "last"), "split")
        along = Window.partitionBy("last").orderBy("depth")
        upper = split.select("name", F.coalesce(F.lag("depth").over(along), F.col("lo")).alias("lo"),
                             F.col("depth").alias("hi"))
        lower = split.groupBy("last", "name", "hi").agg(F.max("depth").alias("lo")).select("name", "lo", "hi")
        fresh = _dressed(leaves.unionByName(upper).unionByName(lower), strings)
        whole = trie.join(split.select("last").distinct(), "last", "left_anti")
        grown = stage(whole.unionByName(fresh), "trie")
        done = exits.where("leaf_key IS NULL").select("name").unionByName(chosen.select("name"))
        left = stage(pending.join(done, "name", "left_anti"), "pending")
        discard(trie, pending, exits, chosen, split)
        trie, pending = grown, left
    return trie


def subtree_sums(nodes: DataFrame, figures: list[str], least: str) -> DataFrame:
    """``nodes`` (key, up) with sums of the figures, and the least of ``least``, over their subtrees.

    In round i every node adds what it has to its 2^i-th ancestor.
    """
    state = stage(nodes.withColumn("above", F.col("up")), "rising")
    while not state.where("above IS NOT NULL").isEmpty():
        risen = state.where("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(
            *(F.sum(c).alias(f"more_{c}") for c in figures), F.min(least).alias(f"more_{least}")
        )
        further = state.select(F.col("key").alias("above"), F.col("above").alias("further"))
        kept = [c for c in nodes.columns if c not in (*figures, least)]
        raised = stage(
            state.join(risen, "key", "left").join(further, "above", "left").select(
                *kept, *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in figures),
                F.least(least, f"more_{least}").alias(least), F.col("further").alias("above"),
            ),
            "rising",
        )
        discard(state)
        state = raised
    return state.drop("above")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one key, sorted, as texts; first is the smallest id of a run."""
    for batch in batches:
        key, conv = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        rows, start = [], 0
        for i in range(1, len(key) + 1):
            if i == len(key) or key[i] != key[start] or i - start == JOINED:
                rows.append((key[start], conv[start], ",".join(map(str, conv[start:i]))))
                start = i
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))],
                names=["key", "first", "ids"],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted runs of each key, which come one after the other."""
    last, state = None, None
    for batch in batches:
        keys, found = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != last:
                if state is not None:
                    keys.append(last)
                    found.append(state.hexdigest())
                last, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digest_batch(keys, found)
    if state is not None:
        yield _digest_batch([last], [state.hexdigest()])


def _digest_batch(keys: list, found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(found, pa.string())})


def end_digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: the conv_ids that end at a node, ascending, joined by commas and hashed.

    A hash is made in one pass. The ids of a hot node are first joined into texts
    in many tasks; one task then reads its texts in order and holds one at a time.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ends.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = runs.mapInArrow(_joined_ids, "key binary, first long, ids string")
    return texts.repartition(parts, "key").sortWithinPartitions("key", "first").mapInArrow(
        _digests, "key binary, ends_sha256 string"
    )


def trie_nodes(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """One row for each node of the prefix trie of the rebuilt conversations."""
    prefixes = rebuilt(turn_prefixes(conversations), family, shared)
    ended = stage(prefixes.where("ends").select("conv_id", F.col("depth").alias("length"), "key", "total"), "ended")
    # Equal conversations are one string, named by the smallest.
    ends = stage(
        ended.groupBy("key").agg(
            F.min("conv_id").alias("name"), F.count("*").alias("n"), F.min("length").alias("length"),
            F.min("total").alias("total"),
        ),
        "ends",
    )
    named = prefixes.withColumnRenamed("conv_id", "name").join(ends.select("name"), "name", "left_semi")
    empty = ends.select("name", F.lit(0).cast("long").alias("depth"), _root().alias("key"),
                        F.lit(0).cast("long").alias("total"))
    named = named.where("depth > 0").select("name", "depth", "key", "total").unionByName(empty)
    after = named.select("name", (F.col("depth") - 1).alias("depth"), F.col("key").alias("next"))
    strings = stage(named.join(after, ["name", "depth"], "left"), "strings")
    trie = build(strings, ends)

    children = trie.groupBy(F.col("up").alias("key")).agg(F.count("*").alias("children"))
    own = ends.select("key", "n", (F.col("n") * F.col("total")).alias("words"), F.col("name").alias("conv_id"))
    nodes = trie.withColumnRenamed("last", "key").join(own, "key", "left").join(children, "key", "left").select(
        "key", "up", F.col("name").alias("rep"), "lo", "hi", "words_lo", F.coalesce("n", F.lit(0)).alias("n_convs"),
        F.coalesce("words", F.lit(0)).alias("member_words"), (F.col("words_hi") - F.col("words_lo")).alias("node_words"),
        F.coalesce("children", F.lit(0)).alias("children"), F.col("children").isNull().cast("long").alias("n_leaves"),
        "conv_id",
    )
    nodes = subtree_sums(nodes, ["n_convs", "member_words", "node_words", "n_leaves"], "conv_id").where("n_convs > 0")
    nodes = stage(nodes, "nodes")
    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
    digests = end_digests(ended)
    nodes = nodes.join(parents, "up", "left").join(digests, "key", "left")
    # Every edge yields its depths; the words above a depth come from the string that made the edge.
    wide = nodes.withColumn("depth", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))))
    above = strings.select(F.col("name").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("total").alias("above"))
    top, bottom = F.col("depth") == F.col("lo") + 1, F.col("depth") == F.col("hi")
    over = F.coalesce("above", F.lit(0))
    # Members' words below, less the words of the distinct turns below.
    saved = F.col("member_words") - F.col("n_convs") * over - (F.col("node_words") - (over - F.col("words_lo")))
    return wide.join(above, ["rep", "depth"], "left").select(
        "conv_id", "depth", F.when(top, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(bottom, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        saved.alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
