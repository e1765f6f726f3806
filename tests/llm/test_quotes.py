from __future__ import annotations

import re

import duckdb

from ledgerlint.llm import quotes
from ledgerlint.llm.oracle import ORACLE_SQL
from tests.compare import difference

SCHEMA = "conv_id long, turn long, role string, text string, lines string"
MAIL = [
    (1, 0, "user", "How do I sort?\nI have  a LIST."),
    (1, 1, "assistant", "Use sorted.\nIt copies."),
    (1, 2, "user", "Ada wrote:\n> how do i sort?\n\nSorry, in place?"),
    (1, 3, "assistant", "> Sorry, in place?\n>> How do I sort?\nUse list.sort."),
    (1, 4, "user", ">It copies.\n> unknown line\nI see"),
    (1, 5, "user", "> Use list.sort.\n> It copies.\n> Use sorted.\nboth"),
    (2, 0, "user", "> How do I sort?\nother talk"),
    (2, 1, None, None),
    (None, 0, "user", "> x\ny"),
    (3, None, "user", "no turn"),
    (3, 1, "user", ""),
    (3, 1, "user", ""),
    (4, 0, "user", "A long thought that goes on\nover the end of a line. Then another one!\nAnd a third."),
    (4, 1, "assistant", "no quote here\nwhatever follows"),
    (4, 2, "user", "> A long thought that\n> goes on over the end of\n> a line.\nWrapped anew."),
    (4, 3, "user", "> then another\n> one!\n\nOnly a part.\n> whatever follows\nA line."),
    (4, 4, "user", "> Wrapped anew.\n> > And a third.\n>\n> Only a part. \x02\x03 A line."),
    (3, 2, "user", "a > b\n  > quoted with blank\n" + "long " * 20000),
]


def brute(rows):
    def parse(text):
        out = []
        for line in re.split(r"\r?\n", text or ""):
            marks = re.match(r"(?:[ \t]*>)*", line)[0]
            body = line[len(marks):]
            norm = re.sub(r"[\s\x00-\x03]+", " ", body).strip(" ").lower()
            out.append((marks.count(">"), body, norm))
        return out

    def sentences(lines):
        passages, before = [], None
        for level, _, norm in lines:
            if norm:
                if before == level:
                    passages[-1][1].append(norm)
                else:
                    passages.append((level, [norm]))
            before = level if norm else None
        return [(level, s) for level, words in passages for s in re.split(r"(?<=[.!?]) ", " ".join(words)) if s]

    parsed = [parse(r[3]) for r in rows]
    cut = [sentences(lines) for lines in parsed]
    wrote = [
        {n for level, n in c if not level} | {n for level, _, n in p if not level and n} for c, p in zip(cut, parsed)
    ]
    reply = {}
    for i, (conv, turn, _, _) in enumerate(rows):
        if conv is None or turn is None:
            continue
        votes = {}
        for level, norm in cut[i]:
            if not level:
                continue
            at = [r[1] for r, w in zip(rows, wrote) if r[0] == conv and r[1] is not None and r[1] < turn and norm in w]
            if at:
                votes[level, max(at)] = votes.get((level, max(at)), 0) + 1
        if votes:
            reply[i] = max((-level, n, origin) for (level, origin), n in votes.items())[2]
    up = {}
    for i, origin in reply.items():
        k = rows[i][:2]
        up[k] = max(up.get(k, origin), origin)
    out = []
    for i, (conv, turn, role, _) in enumerate(rows):
        own = []
        for j, (level, body, norm) in enumerate(parsed[i]):
            nxt = parsed[i][j + 1][0] if j + 1 < len(parsed[i]) else 0
            if level == 0 and not (re.search(r"(wrote|writes|said):$", norm) and nxt > level):
                own.append(body)
        at, depth = turn, 0
        while (conv, at) in up:
            at, depth = up[conv, at], depth + 1
        out.append((conv, turn, role, "\n".join(own).strip(" \t\r\n"), reply.get(i), at, depth))
    return out


def test_equals_brute_force(spark):
    frame = spark.createDataFrame([(*r, "clash") for r in MAIL], SCHEMA).repartition(4)
    got = quotes.link_quotes(frame).collect()
    names = ("conv_id", "turn", "role", "text", "reply_to", "thread", "depth")
    assert sorted(repr(tuple(r[n] for n in names)) for r in got) == sorted(map(repr, brute(MAIL)))
    first = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [r["turn"] for r in first] == [0, 2, 3, 1, 4, 5]
    assert [r["position"] for r in first] == list(range(6))
    assert [r["reply_to"] for r in first] == [None, 0, 2, None, 1, 1]


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", MAIL)
    frame = spark.createDataFrame([(*r, "clash") for r in MAIL], SCHEMA).repartition(3)
    sql = ORACLE_SQL["op9_quote_linking"]
    assert difference(spark, con, "", lambda spark, sf_dir: quotes.link_quotes(frame), sql) is None


def test_wrapped_and_partial_quotes_link(spark):
    frame = spark.createDataFrame(MAIL, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in quotes.link_quotes(frame.where("conv_id = 4")).collect()}
    assert [(got[t]["reply_to"], got[t]["n_quoted"], got[t]["n_linked"]) for t in range(5)] == [
        (None, 0, 0), (None, 0, 0), (0, 1, 1), (1, 2, 2), (3, 4, 4)
    ]


def test_a_common_sentence_of_a_hot_conversation(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        rows = [(1, t, "user", f"> Me too.\nMe too.\nturn {t}") for t in range(3000)]
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        got = quotes.link_quotes(frame.repartition(10)).collect()
        assert {r["turn"]: r["reply_to"] for r in got} == {t: t - 1 if t else None for t in range(3000)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_every_reply_follows_its_message(spark):
    rows = [(7, 0, "user", "line 0")]
    rows += [(7, t, "user", f"> line {t - 1 - t % 3 if t > 3 else 0}\nline {t}") for t in range(1, 60)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in quotes.link_quotes(frame).collect()}
    for r in got.values():
        if r["reply_to"] is not None:
            assert got[r["reply_to"]]["position"] < r["position"]
            assert got[r["reply_to"]]["depth"] == r["depth"] - 1
    assert all(r["thread"] == 0 for r in got.values())


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame(MAIL, "conv_id long, turn long, role string, text string")
    plan = quotes.link_quotes(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link_quotes(frame).collect() == []
