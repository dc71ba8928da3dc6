"""Registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    decontamination, language_id, line_dedup, merkle, mixing, ngram_join, secret_scan, simhash, spelling, token_counts, token_shards,
    topk_search, toxicity,
)
from tidemark.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@registered
def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-shards")
    token_shards.write_shards(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_shards.read_shards(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@registered
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@registered
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_source_mixing"] = mixing.ORACLE


@registered
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


ORACLES["op10_line_dedup"] = line_dedup.ORACLE


@registered
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@registered
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


@registered
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.detect_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "neighbours")


@registered
def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLES["op6_topk_search"] = topk_search.ORACLE


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items: their texts, and those cut in two. The cut is no real answer, so items
    are verified by the whole text."""
    question, answer = decontamination.question_and_answer(F.col("text"))
    return table(spark, sf_dir, "benchmark").select("item_id", "text", question.alias("question"), answer.alias("answer"))


@registered
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = benchmark_items(spark, sf_dir)
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), items, question_col="text", answer_col=None)


@registered
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@registered
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"), MANIFEST_FIELDS)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLES["op11_merkle_manifest"] = merkle.oracle(MANIFEST_FIELDS)


@registered
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = spelling.ORACLE


@registered
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))
