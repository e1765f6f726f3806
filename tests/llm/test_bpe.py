from __future__ import annotations

import hashlib
import struct
import weakref
from collections.abc import Iterator

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pathlib import Path
from types import SimpleNamespace
from pyspark.sql import functions as F

from ledgerlint.llm import bpe, common
from ledgerlint.llm.queries import tokenizer

RAW = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
RANKS = bpe.read_ranks(RAW)
REAL = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
LONGEST = max(map(len, RANKS))
MERGER = bpe.Merger(RANKS)

TEXTS = [
    None, "", " ", "\n\n  a", "It's what we'll see, isn't it?", "ciónadoos ñé ß 你好 мир", "a" * 5000,
    "ab" * 4000 + "c", "\x1c\x1d\u0085 　 x", "<|endoftext|>", "!!!???$$$ 123 ½ Ⅷ",
    "🙂👨‍👩‍👧 ȩ́", "word " * 3000, "\t\tx\r\n\r\ny  ",
]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_pieces_equal_the_library(text):
    import regex

    pieces = [p.encode() for p in regex.findall(public_tokenizers.PATTERN, text)]
    want = REAL.encode_ordinary(text)
    assert [i for p in pieces for i in bpe.merge(p, RANKS, LONGEST)] == want
    assert b"".join(MERGER.encode(pieces)) == struct.pack(f"<{len(want)}I", *want)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abe hint", min_size=1, max_size=200))
def test_long_pieces_equal_the_library(text):
    piece = text.replace(" ", "") or "a"
    want = REAL.encode_ordinary(piece)
    assert bpe.merge(piece.encode(), RANKS, LONGEST) == want
    assert MERGER.encode([piece.encode(), b"a"])[0] == struct.pack(f"<{len(want)}I", *want)


@pytest.fixture(scope="module")
def coded(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS + ["repeated", "repeated"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    return rows, bpe.digests(docs, tokenizer(spark)).collect()


def test_digests(coded):
    rows, out = coded
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    for doc_id, text, _ in rows:
        ids = REAL.encode_ordinary(text or "")
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(docs, tokenizer(spark)).collect() == []


def test_digests_take_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    plan = bpe.digests(docs, tokenizer(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_encode_and_decode_agree_with_the_two(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    vocabulary = tokenizer(spark)
    one = docs.select("doc_id", vocabulary.encode_and_decode(F.col("text")).alias("coded")).select("doc_id", "coded.*")
    two = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).drop("text")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select("doc_id", "ids", "decoded").collect()))


def test_memory_is_given_back_once_the_task_has_freed_it(monkeypatch):
    class Held:
        pass

    seen, alive = [], []

    def pool():
        return SimpleNamespace(release_unused=lambda: seen.append([ref() for ref in alive]))

    @common.gives_back
    def run(batches: Iterator[int]) -> Iterator[int]:
        held = Held()
        alive.append(weakref.ref(held))
        for batch in batches:
            yield batch + bool(held)

    monkeypatch.setattr(common.pa, "default_memory_pool", pool)
    out = run(iter([1, 2]))
    assert next(out) == 2 and not seen
    assert list(out) == [3] and seen == [[None]]
