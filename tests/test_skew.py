"""One key with most of the rows: joins are split, results are whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import relational as rel

SMALL_PARTITIONS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for k, v in SMALL_PARTITIONS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


@pytest.fixture
def hot(spark):
    return spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h")
    )


@pytest.fixture
def few(spark):
    return spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def test_hot_left_side(small_partitions, hot, few):
    plan, rows = final_plan(rel.join_left(hot, few, ["k"]))
    assert "isSkew=true" in plan or "skew=true" in plan
    assert len(rows) == 40_000 and all(r["v"] == (2 * r["k"] if r["k"] < 2000 else None) for r in rows)


def test_hot_right_side(small_partitions, hot, few):
    plan, rows = final_plan(rel.join_left(few, hot, ["k"], many=True))
    assert "isSkew=true" in plan or "skew=true" in plan
    matched = sum(r["h"] is not None for r in rows)
    assert matched == hot.where("k < 2000").count()
    assert len(rows) - matched == 2000 - hot.where("k < 2000").select("k").distinct().count()


def test_full_join(small_partitions, hot, few):
    plan, rows = final_plan(rel.join_full(hot, few, ["k"]))
    assert "isSkew=true" in plan or "skew=true" in plan
    assert len(rows) == 40_000 + 2000 - hot.where("k < 2000").select("k").distinct().count()


def test_anti_join_moves_only_keys_of_the_hot_side(small_partitions, hot, few):
    plan, rows = final_plan(rel.join_anti(few, hot, ["k"]))
    assert "HashAggregate" in plan
    assert len(rows) == 2000 - hot.where("k < 2000").select("k").distinct().count()
