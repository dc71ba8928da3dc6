"""The corpus pipeline: stages over ``documents``, each written before the next.

Toxic texts go, one text of each group of near copies stays, texts that hold a
test item go, sources are mixed to their weights, and what is left is written
as token shards. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, mixing, ngram_join, token_shards, toxicity
from tidemark.llm.queries import benchmark_items, table, vocabulary
from tidemark.session import scratch_dir

# Share of the usual encoded chunks a worker keeps; it still holds memory that earlier stages took.
KEPT_SHARE = 0.15

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels.where(~toxicity.held_out())))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, benchmark_items(spark, sf_dir), question_col="text", answer_col=None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-shards")
    token_shards.write_shards(docs, path, vocabulary("word_bpe_49k.json"), kept_share=KEPT_SHARE)
    return token_shards.read_shards(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_test_items),
    ("source_mixing", mix_sources),
    ("token_shards", write_tokens),
]

# Learned scores and token ids have no SQL; the tests hold the stages against
# plain versions of their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
