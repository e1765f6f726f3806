"""Registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlint.llm import (
    boilerplate, bpe, divergence, hnsw, line_dedup, mixing, neighbour_graph, ngram_join, prefix_trie, quality, quotes, topk,
    toxicity,
)
from ledgerlint.llm.common import table
from ledgerlint.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def tokenizer(spark: SparkSession) -> bpe.Vocabulary:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.Vocabulary(spark, path, public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer(spark))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(table(spark, sf_dir, "pages"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), weights=(1, 2, 3), share=1.0, most=3.0)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), step=20, k=20)


def op9_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"), family=20, shared=4)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), step=100, k=10)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality": op2_quality,
    "op3_main_text": op3_main_text,
    "op4_ngram_join": op4_ngram_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_near_vectors": op7_near_vectors,
    "op8_hnsw": op8_hnsw,
    "op9_quote_linking": op9_quote_linking,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_topk": op12_topk,
    "op13_divergence": op13_divergence,
}
