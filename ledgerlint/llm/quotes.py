"""Chat formatting by quotation linking, with DataFrame functions only.

A line's quote level is the number of ``>`` marks before it. Neighbouring lines of one
level, up to a blank line, are a passage: they are joined and normalised across line
ends, so that a passage wrapped anew is the same, and cut into sentences, so that a
part of it is found too. Each quoted sentence is hashed and linked to the latest
earlier message of the same conversation that wrote it itself, as a sentence or as a
line. A message replies to the message that wrote most of its outermost quoted
sentences; ties go to the later one. Messages linked in this way form threads. The result has every message without its
quotes, in reply order: a thread stands where its first message stood, and
within it each message comes after the one it replies to.

Links are found with running maxima over the messages that share a hash, not by
pairing them, and positions by counting; both run over range partitions, with what a
partition begins with carried over, so a conversation or a sentence that holds a
third of all rows is spread over many tasks.

Cases: a null text is empty; a message without quotes keeps its text but for
outer white space; blank lines end a passage and link with nothing; a null conversation or turn
links with nothing, and its thread is the message itself; messages that share a
turn are ordered by role and text; repeated rows are all returned; other
columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import row_key
from ledgerlint.sources.staging import stage

_MARKS = r"^(?:[ \t]*>)+"
_ROW_IN_PARTITION = (1 << 33) - 1


#: Set between passages, and after their level; normalised texts do not hold them.
_CUT, _LEVEL = "\x02", "\x03"


def _lines(text: Column) -> Column:
    """Lines as (level, body, norm): marks counted and removed, text normalised."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        body = F.substr(line, F.length(marks) + 1)
        norm = F.lower(F.btrim(F.regexp_replace(body, r"[\s\x00-\x03]+", " ")))
        return F.struct(
            F.length(F.regexp_replace(marks, r"[^>]", "")).alias("level"),
            body.alias("body"), norm.alias("norm"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), parse)


def _sentences(lines: Column) -> Column:
    """Sentences of all passages, as (level, norm)."""

    def joined(line: Column, i: Column) -> Column:
        before = F.try_element_at(lines, F.when(i > 0, i))
        starts = F.coalesce((before["norm"] == "") | (before["level"] != line["level"]), F.lit(True))
        opening = F.concat(F.lit(_CUT), line["level"].cast("string"), F.lit(_LEVEL))
        return F.when(line["norm"] == "", "").otherwise(
            F.concat(F.when(starts, opening).otherwise(F.lit(" ")), line["norm"])
        )

    def cut(passage: Column) -> Column:
        level = F.substring_index(passage, _LEVEL, 1)
        text = F.substr(passage, F.length(level) + 2)
        parts = F.split(F.regexp_replace(text, r"([.!?]) ", f"$1{_CUT}"), _CUT)
        return F.transform(parts, lambda s: F.struct(level.cast("int").alias("level"), s.alias("norm")))

    passages = F.filter(F.split(F.array_join(F.transform(lines, joined), ""), _CUT), lambda x: x != "")
    return F.flatten(F.transform(passages, cut))


def _own_text(lines: Column) -> Column:
    """The lines that are no quotes, without the heads that introduce quotes."""

    def own(line: Column, i: Column) -> Column:
        following = F.coalesce(F.try_element_at(lines, i + 2)["level"], F.lit(0))
        head = line["norm"].rlike(r"(wrote|writes|said):$") & (following > line["level"])
        return (line["level"] == 0) & ~head

    return F.btrim(
        F.array_join(F.transform(F.filter(lines, own), lambda x: x["body"]), "\n"), F.lit(" \t\r\n")
    )


def _latest_before(both: DataFrame) -> DataFrame:
    """``both`` with origin: the latest source_turn of its (conv_id, hash) before its turn."""
    key = ["conv_id", "hash"]
    ordered = both.repartitionByRange(*key, "turn").withColumn("part", F.spark_partition_id())
    ordered = stage(ordered, "voiced")
    local = Window.partitionBy(*key, "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    # A sentence in several parts: what the parts before hold of it, one row for each part.
    tops = ordered.groupBy(*key, "part").agg(F.max("source_turn").alias("top"))
    spread = tops.join(tops.groupBy(*key).count().where("count > 1").select(*key), key, "left_semi")
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select(*key, "part", F.max("top").over(earlier).alias("carried"))
    inside = ordered.withColumn("inside", F.max("source_turn").over(local))
    return inside.join(carried, [*key, "part"], "left").withColumn("origin", F.greatest("inside", "carried"))


def _links(parsed: DataFrame) -> DataFrame:
    """conv_id, mid and the turn replied to, for messages whose quotes were found."""
    placed = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")

    def voiced(messages: DataFrame, units: Column) -> DataFrame:
        said = messages.select("conv_id", "turn", "mid", F.explode(units).alias("said")).where(F.col("said.norm") != "")
        return said.select("conv_id", "turn", "mid", "said.level", F.md5(F.col("said.norm")).alias("hash"))

    # Only messages with a mark at the start of a line are parsed for quotes.
    quoted = voiced(placed.where("marked"), F.col("sentences")).where("level > 0")
    quoted = quoted.groupBy("conv_id", "hash", "turn", "mid", "level").agg(F.count("*").alias("n"))
    wanted = quoted.select("conv_id", "hash").distinct()
    single = F.transform("lines", lambda x: F.struct(x["level"].alias("level"), x["norm"].alias("norm")))
    written = voiced(placed, F.concat("sentences", single)).where("level = 0")
    written = written.join(wanted, ["conv_id", "hash"], "left_semi")
    written = written.select("conv_id", "hash", "turn").distinct().withColumn("source_turn", F.col("turn"))
    found = _latest_before(quoted.unionByName(written, allowMissingColumns=True))
    found = found.where("mid IS NOT NULL AND origin IS NOT NULL")
    votes = found.groupBy("conv_id", "turn", "mid", "origin", "level").agg(F.sum("n").alias("n"))
    best = F.max(F.struct(-F.col("level"), F.col("n"), F.col("origin"))).alias("best")
    return votes.groupBy("conv_id", "turn", "mid").agg(best, F.sum("n").alias("n_linked")).select(
        "conv_id", "turn", "mid", "n_linked", F.col("best.origin").alias("reply_to")
    )


def _threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, thread and depth of turns that reply, by pointer doubling.

    A turn replies to an earlier one, so there is no cycle, and the distance
    covered doubles in every round.
    """
    above = stage(
        links.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("thread")).withColumn("depth", F.lit(1)),
        "threads",
    )
    while True:
        up = above.select(
            F.col("conv_id").alias("c"), F.col("turn").alias("t"),
            F.col("thread").alias("t2"), F.col("depth").alias("d2"),
        )
        joined = above.join(up, (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t")), "left")
        step = stage(
            joined.select(
                "conv_id", "turn", F.coalesce("t2", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"),
                F.col("t2").isNotNull().alias("moved"),
            ),
            "threads",
        )
        above = step.drop("moved")
        if step.where("moved").isEmpty():
            return above


def link_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) in reply order, without quotes.

    Returns conv_id, position, turn, role, text, reply_to, thread, depth,
    n_quoted, n_linked and formatted.
    """
    named = messages.select("conv_id", "turn", "role", "text").withColumn(
        "marked", F.coalesce(F.col("text").rlike(r"(?m)^[ \t]*>"), F.lit(False))
    )
    parsed = named.withColumn("mid", row_key("conv_id", "turn", "role", "text")).withColumn(
        "lines", _lines(F.col("text"))
    ).withColumn("sentences", _sentences(F.col("lines")))
    links = stage(_links(parsed), "links")
    threads = _threads(links)
    levels = F.filter("sentences", lambda x: x["level"] > 0)
    plain = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n", "\n"), F.lit(" \t\r\n"))
    clean = parsed.where("marked").select(
        "conv_id", "turn", "role", "mid", F.size(levels).alias("n_quoted"), _own_text(F.col("lines")).alias("text")
    ).unionByName(
        parsed.where("NOT marked").select(
            "conv_id", "turn", "role", "mid", F.lit(0).alias("n_quoted"), plain.alias("text")
        )
    )
    clean = clean.join(links.select("mid", "reply_to", "n_linked"), "mid", "left")
    clean = clean.join(threads, ["conv_id", "turn"], "left")
    clean = clean.withColumn("thread", F.coalesce("thread", "turn")).withColumn(
        "depth", F.coalesce("depth", F.lit(0))
    ).withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))

    order = [
        F.col("conv_id"), F.col("thread").asc_nulls_last(), F.col("depth"),
        F.col("turn").asc_nulls_last(), F.col("role"), F.col("mid"),
    ]
    ordered = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stage(
        ordered.withColumn("part", F.spark_partition_id()).withColumn(
            "at", F.monotonically_increasing_id().bitwiseAND(_ROW_IN_PARTITION)
        ),
        "ordered",
    )
    # One row for each partition.
    sizes = ordered.groupBy("part").count()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    placed = ordered.join(sizes, "part").withColumn("place", F.col("at") + F.col("offset"))
    starts = placed.groupBy(F.col("conv_id").alias("c")).agg(F.min("place").alias("start"))
    placed = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("c")))
    return placed.select(
        "conv_id", (F.col("place") - F.col("start")).alias("position"), "turn", "role", "text",
        "reply_to", "thread", F.col("depth").cast("int").alias("depth"),
        F.col("n_quoted").cast("int").alias("n_quoted"), F.col("n_linked").cast("long").alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text"), F.lit("\n")).alias("formatted"),
    )
