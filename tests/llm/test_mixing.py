from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.llm import mixing


def targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """The sharing step by step: cut what is above its cap, share the excess anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: dict = {}
    while True:
        free = [s for s in order if s not in full]
        left = sum(sizes.values()) - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return full | share
        full |= {s: most * sizes[s] for s in above}


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 50 == 1, F.lit(None)).otherwise(F.col("source"))
    )
    rows = mixing.mix_plan(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want = targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2
    for source in want:  # whole epochs come before a part of one
        copies = {r["copies"] for r in rows if r["source"] == source and r["size"]}
        assert max(copies) - min(copies) <= 1
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix_plan(docs).collect()), key=repr)


def test_cells_do_not_change_the_cut(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = sorted(map(tuple, mixing.mix_plan(docs).collect()))
    monkeypatch.setattr(mixing, "CELLS", 2)
    assert sorted(map(tuple, mixing.mix_plan(docs).collect())) == want


def test_better_documents_are_taken_more(spark):
    made = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "clean words only here").otherwise("9# 9# 9# 9#").alias("text"),
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
    )
    taken = Counter()
    for r in mixing.mix_plan(made, weights=(1, 3)).collect():
        if r["source"] == "a":
            taken[r["doc_id"] % 2] += r["copies"]
    assert taken[0] > 2 * taken[1]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = mixing.mix_plan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["size"] == r["taken"] == 0 for r in rows if r["doc_id"] in (2, 3, 5))
    assert len({r["copies"] for r in rows if r["doc_id"] == 1}) == 1
    mixed = mixing.mix_rows(odd_docs)
    assert mixed.schema == odd_docs.schema
    got, want = Counter(r["doc_id"] for r in mixed.collect()), Counter()
    for r in rows:
        if r["copies"]:
            want[r["doc_id"]] += r["copies"]
    assert got == want
    assert mixing.mix_plan(no_docs).collect() == [] and mixing.mix_rows(no_docs).collect() == []


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = mixing.mix_rows(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_alike_rows_are_split_by_number(spark):
    rows = [(None, "three plain words", "a")] * 200 + [(7, "two words", "a")] * 50 + [(i, "one", "b") for i in range(2000)] + [(None, f"own text {i}", "c") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix_plan(docs, weights=(1, 4, 2)).collect()
    assert len(found) == len(rows)
    for source, largest in (("a", 3), ("b", 1), ("c", 3)):
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest / 2
    mixed = Counter(r["source"] for r in mixing.mix_rows(docs, weights=(1, 4, 2)).collect())
    assert mixed == Counter({s: sum(r["copies"] for r in found if r["source"] == s) for s in "abc"})


def test_rows_without_words_go_with_their_source(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "some words", "a"), (4, " ", "b")], "doc_id bigint, text string, source string")
    assert sorted(r["doc_id"] for r in mixing.mix_rows(docs).collect()) == [1, 2, 3]
