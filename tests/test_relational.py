from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import numbering, relational as rel
from tidemark.operators.numbering import number_rows

LEFT = [(1, "a"), (1, "b"), (None, "n"), (None, "m"), (3, "c")]
RIGHT = [(1, "x"), (1, "y"), (None, "z"), (4, "w")]


def pairs(kind):
    out = [(k, l, r) for k, l in LEFT for j, r in RIGHT if k == j]
    if kind in ("left", "full"):
        out += [(k, l, None) for k, l in LEFT if k not in [j for j, _ in RIGHT]]
    if kind == "full":
        out += [(j, None, r) for j, r in RIGHT if j not in [k for k, _ in LEFT]]
    return sorted(out, key=repr)


@pytest.fixture
def sides(spark):
    return spark.createDataFrame(LEFT, "k int, l string"), spark.createDataFrame(RIGHT, "k int, r string")


@pytest.mark.parametrize("many", [False, True])
def test_left_join(sides, rows, many):
    assert rows(rel.join_left(*sides, ["k"], many=many), "k", "l", "r") == pairs("left")


def test_full_join(sides, rows):
    assert rows(rel.join_full(*sides, ["k"]), "k", "l", "r") == pairs("full")
    assert rows(rel.join_full(*reversed(sides), ["k"]), "k", "l", "r") == pairs("full")


def test_anti_and_semi(sides, rows):
    assert rows(rel.join_anti(*sides, ["k"])) == [(3, "c")]
    assert rows(rel.join_semi(*sides, ["k"])) == sorted([r for r in LEFT if r[0] != 3], key=repr)


def test_joins_are_equi_joins(sides):
    for df in (rel.join_left(*sides, ["k"], many=True), rel.join_full(*sides, ["k"]), rel.join_anti(*sides, ["k"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shared_column_that_is_no_key_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        rel.join_left(df, df, ["k"])


def test_pair_lists(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"], [7, 8]), (2, [], [9]), (3, ["c"], None)], "i int, x array<string>, y array<int>")
    assert rows(rel.pair_lists(df, "x", "y", ("x1", "y1"))) == [(1, "a", 7), (1, "a", 8), (1, "b", 7), (1, "b", 8)]


def test_ordered_distinct_concat(spark, rows):
    data = [("g", 3, "x"), ("g", 1, "y"), ("g", 2, "x"), ("g", 4, None), ("g", None, "a"), ("h", 1, None), (None, 1, "q")]
    df = spark.createDataFrame(data, "g string, o int, v string")
    assert rows(rel.ordered_distinct_concat(df, ["g"], ["v"], ["o"])) == [("g", "y|x|NA|a"), ("h", "NA"), (None, "q")]


def test_repeat_summary(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"], "k string")
    assert tuple(rel.repeat_summary(df, ["k"]).first()) == (3, 3, 3)


def test_filter_present(spark, rows):
    df = spark.createDataFrame([("a",), ("",), (None,), ("a",), ("b",)], "k string")
    assert rows(rel.filter_present(df, "k")) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        rel.filter_present(df.where("k = ''"), "k")


def test_filter_excluded(spark, rows):
    df = spark.createDataFrame([("All Rows",), ("x AA - Restricted y",), (None,), ("All Rows 2",)], "n string")
    assert rows(rel.filter_excluded(df, "n")) == [("All Rows 2",)]


def test_lookup(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rel.lookup_by_key(df, "k", 1).count() == 1
    with pytest.raises(LookupError):
        rel.lookup_by_key(df, "k", 2)


def test_select_named_with_awkward_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "c.d", "e`f"])
    assert rel.select_named(df, ["c.d", "e`f", "a b"]).columns == ["c.d", "e`f", "a b"]


@pytest.fixture
def audit(spark):
    when = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    data = [(t, *["x"] * 7, f"e{i}", i) for i, t in enumerate(when)]
    return spark.createDataFrame(data, ", ".join(f"{c} {'timestamp_ntz' if c == 'time' else 'string'}" for c in rel.ACTIVITY_COLUMNS) + ", more int")


def test_activity_window(audit, rows):
    window = rel.activity_window(audit, "2024-01-02", dt.datetime(2024, 1, 3))
    assert window.columns == rel.ACTIVITY_COLUMNS
    assert rows(window, "eventText") == [("e1",), ("e2",)]
    assert rows(rel.activity_window(audit, start="2024-01-03 00:00:01"), "eventText") == [("e3",)]
    assert rows(rel.activity_window(audit, "2024-01-02", limit=1, offset=1), "eventText") == [("e2",)]


def test_activity_window_over_milliseconds(audit, rows):
    millis = audit.withColumn("time", F.unix_millis(F.col("time").cast("timestamp")))
    for start, end in ((dt.datetime(2024, 1, 2), dt.date(2024, 1, 3)), (1704153600000, "1704240000000")):
        assert rows(rel.activity_window(millis, start, end), "eventText") == [("e1",), ("e2",)]


def test_activity_bounds_of_any_kind(audit, rows):
    millis = audit.withColumn("time", F.unix_millis(F.col("time").cast("timestamp")))
    east = dt.timezone(dt.timedelta(hours=2))
    for log in (audit, millis):
        for start in ("2024-01-03 00:00:01", "2024-01-03T02:00:01+02:00", dt.datetime(2024, 1, 3, 2, 0, 1, tzinfo=east), dt.datetime(2024, 1, 3, 0, 0, 0, 100)):
            assert rows(rel.activity_window(log, start), "eventText") == [("e3",)]
        for wrong in ("soon", 1.5):
            with pytest.raises((ValueError, TypeError)):
                rel.activity_window(log, wrong)


def test_activity_window_is_pushed_down(audit, tmp_path, spark):
    audit.write.parquet(str(tmp_path / "log"))
    window = rel.activity_window(spark.read.parquet(str(tmp_path / "log")), "2024-01-02", "2024-01-03")
    assert "GreaterThanOrEqual(time,2024-01-02T00:00)" in window._jdf.queryExecution().executedPlan().toString()


def test_sort_puts_missing_last(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (1, 3)], "a int, b int")
    assert [r["b"] for r in rel.sort_rows(df, ["a", "b"]).collect()] == [3, 2, 1]


@pytest.mark.parametrize("band", [200_000, 3])
def test_pages(spark, band, monkeypatch):
    monkeypatch.setattr("tidemark.operators.numbering.BAND_ROWS", band)
    values = list(range(200))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    page = lambda **kw: [r["v"] for r in rel.page_rows(df, ["v"], **kw).collect()]
    assert page(limit=7, offset=20) == list(range(20, 27))
    assert page(limit=50, offset=190) == list(range(190, 200))
    assert page(offset=195) == [195, 196, 197, 198, 199]
    assert page(offset=3, limit=1000) == list(range(3, 200))
    assert page(offset=200) == [] == page(offset=500, limit=3)
    assert page() == list(range(200))


@pytest.mark.parametrize("sample", [4096, 50])
def test_pages_of_ties_and_gaps(spark, sample, monkeypatch):
    """Pages together are the sorted table, whatever is alike in the order."""
    monkeypatch.setattr("tidemark.operators.numbering.BAND_ROWS", 20)
    monkeypatch.setattr("tidemark.operators.numbering.SAMPLE", sample)
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "hot", None, "a", "z"]), rng.choice([None, 1.5, 2.0]), i // 2) for i in range(600)]
    df = spark.createDataFrame(data, "k string, v double, i int").repartition(5)
    whole = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2]))
    for offset in (0, 17, 299, 590):
        for limit in (1, 40, 0):
            got = [tuple(r) for r in rel.page_rows(df, ["k", "v"], limit=limit, offset=offset).collect()]
            assert got == (whole[offset : offset + limit] if limit else whole[offset:])


def test_a_deep_page_moves_only_its_surroundings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.operators.numbering.BAND_ROWS", 1000)
    spark.range(0, 300_000, 1, 4).select((F.col("id") * 7919 % 300_000).alias("v")).write.parquet(str(tmp_path / "t"))
    moved = []
    plain = numbering.number_rows
    monkeypatch.setattr(numbering, "number_rows", lambda df, *a, **kw: moved.append(df.count()) or plain(df, *a, **kw))
    page = rel.page_rows(spark.read.parquet(str(tmp_path / "t")), ["v"], limit=10, offset=200_000)
    assert [r["v"] for r in page.collect()] == list(range(200_000, 200_010))
    assert moved[0] < 20_000


def test_stack_rows(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2.5, True)], "i double, b boolean")
    assert rows(rel.stack_rows(a, b), "i", "s", "b") == [(1.0, "x", None), (2.5, None, True)]
    with pytest.raises(TypeError):
        rel.stack_rows(a, spark.createDataFrame([("t",)], "i string"))


@pytest.mark.parametrize("parts", ["1", "40"])
@pytest.mark.parametrize("kind", ["number", "text", "gaps"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_groups_are_numbered_across_partitions(spark, rows, kind, keys, parts):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "hot", None, None, "c1", "c2"]), i, rng.randint(0, 50)) for i in range(1500)]
    df = spark.createDataFrame(data, "k string, i int, v int").repartition(4)
    shown = {"number": F.col("v"), "text": F.concat(F.lit("t"), "v"), "gaps": F.when(F.col("v") > 10, F.col("v"))}[kind]
    df = df.withColumn("o", shown)
    group = Window.partitionBy(*keys)
    plain = df.withColumn("rn", F.row_number().over(group.orderBy(F.col("o").asc_nulls_last(), "i")).cast("bigint")).withColumn(
        "n", F.count(F.lit(1)).over(group)
    )
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows(number_rows(df, keys, ["o", "i"])) == rows(plain)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_a_group_of_alike_rows_is_spread(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.lit("hot").alias("k"), F.lit(1).alias("o"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = numbering.placed_rows(df, ["k", "o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert placed.groupBy("_part").count().agg(F.max("count")).first()[0] < 12_000
    numbered = number_rows(df, ["k"], ["o"])
    assert numbered.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn"), F.max("n")).first() == (20_000, 1, 20_000, 20_000)
