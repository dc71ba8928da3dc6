from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.servicetypes import parse_as, parse_user_time, service_type
from tidemark.operators import nested
from tidemark.operators.schema import cast_typed, columns_of, dataset_schema, infer_types, inferred_columns


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_parsing(spark):
    assert values(spark, ["1", "2.9", "-2.9", "9999999999", "x", "", None], lambda c: parse_as(c, "LONG")) == [1, 2, -2, 9999999999, None, None, None]
    assert values(spark, ["1.5", "1e3", "x", None], lambda c: parse_as(c, "DOUBLE")) == [1.5, 1000.0, None, None]
    days = ["2024-01-05", "2024-1-5", "2024-01-05T10:00:00", "2024/01/05", "2024-13-01", "x"]
    day = dt.date(2024, 1, 5)
    assert values(spark, days, lambda c: parse_as(c, "DATE")) == [day, day, day, None, None, None]
    assert values(spark, days, lambda c: parse_as(c, "DATE", True)) == [day, day, day, day, None, None]
    times = ["2024-01-05T10:00:00", "2024-01-05T10:00:00.75Z", "2024-01-05 10:00:00", "2024-01-05", "2024-01-05T25:00:00"]
    ten = dt.datetime(2024, 1, 5, 10)
    assert values(spark, times, lambda c: parse_as(c, "DATETIME")) == [ten, ten, None, None, None]
    assert values(spark, times[:3], lambda c: parse_as(c, "DATETIME", True)) == [ten, ten.replace(microsecond=750000), ten]


def test_user_times(spark):
    texts = ["2024-03-10T02:30:00Z", "2024-03-10T02:30:00.123Z", "2024-03-10T02:30:00.1234567Z", "2024-03-10T02:30:00", "x", None]
    base = dt.datetime(2024, 3, 10, 2, 30)
    want = [base, base.replace(microsecond=123000), base.replace(microsecond=123456), None, None, None]
    assert values(spark, texts, parse_user_time) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, texts, parse_user_time) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_inference(spark):
    data = [("2024-01-05T10:00:00", "2024-01-05 10:00:00.5", "2024-01-05", "1", "1.5", "x", None, "2024-01-05"),
            ("2024-02-05 10:00:00Z", None, "2024/02/05", "22", "3", "2024-01-05", None, "2024-01-05 x")]
    df = spark.createDataFrame(data, ", ".join(f"c{i} string" for i in range(8))).withColumn("flag", F.lit(True)).withColumn("d", F.lit(1).cast("decimal(5,1)"))
    assert [t for _, t in inferred_columns(df)] == ["DATETIME", "DATETIME", "DATE", "STRING", "STRING", "STRING", "STRING", "STRING", "STRING", "DOUBLE"]
    assert [t for _, t in inferred_columns(df, numbers=True)][3:5] == ["LONG", "DOUBLE"]
    assert [r["position"] for r in infer_types(df).collect()] == list(range(1, 11))


def test_inferred_text_casts_back(spark):
    df = spark.createDataFrame([("2024/01/05", "2024-01-05 10:00:00")], "a string, b string")
    typed = cast_typed(df, dict(inferred_columns(df)), any_format=True)
    assert typed.dtypes == [("a", "date"), ("b", "timestamp_ntz")]
    assert typed.first().a == dt.date(2024, 1, 5)


def test_service_types(spark):
    df = spark.sql("SELECT 1Y a, 1S b, 1 c, 1L d, 1.5F e, 1.5D f, 1.5 g, date'2024-01-01' h, timestamp'2024-01-01' i, "
                   "timestamp_ntz'2024-01-01' j, 'x' k, true l, array(1) m, map(1, 2) n, named_struct('x', 1) o")
    assert [service_type(f.dataType) for f in df.schema] == ["LONG"] * 4 + ["DOUBLE"] * 3 + ["DATE"] + ["DATETIME"] * 2 + ["STRING"] * 5
    schema = dataset_schema(df)
    assert [(r["name"], r["type"]) for r in schema.orderBy("position").collect()] == columns_of(df)
    assert {r["rows"] for r in schema.collect()} == {1}


def test_widen(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": [1, 2]}}'), (2, "{}"), (3, "broken")], "i int, r string")
    wide = nested.widen_records(df, "r", "a bigint, b struct<c: array<int>>")
    assert wide.columns == ["i", "a", "b"]
    assert rows(wide, "i", "a", "b.c") == [(1, 1, [1, 2]), (2, None, None), (3, None, None)]
    again = nested.widen_records(wide.select("i", F.struct("a", "b").alias("r")), "r")
    assert rows(again, "i", "a") == [(1, 1), (2, None), (3, None)]
    assert rows(nested.widen_records(df, "r"), "i", "a", "b.c") == rows(wide, "i", "a", "b.c")
    mixed = spark.createDataFrame([('{"a": 1, "x": null}',), ('{"a": "t", "o": {"p": true}}',)], "r string")
    found = nested.infer_fields(mixed, "r")
    assert {f.name: f.dataType.simpleString() for f in found} == {"a": "string", "x": "string", "o": "struct<p:boolean>"}
    assert rows(nested.widen_records(mixed, "r"), "a", "o.p") == [("1", None), ("t", True)]
    with pytest.raises(ValueError):
        nested.widen_records(df.select(F.lit("[1]").alias("r")), "r")


def test_flatten(spark):
    df = spark.sql("SELECT 1 a, named_struct('b', 2, 'c', named_struct('d', 3, 'e', array(4))) s")
    flat = nested.flatten_records(df)
    assert (flat.columns, tuple(flat.first())) == (["a", "s_b", "s_c_d", "s_c_e"], (1, 2, 3, [4]))


def test_explodes(spark, rows):
    df = spark.createDataFrame([(1, [7, 8]), (2, []), (3, None)], "i int, m array<bigint>")
    assert rows(nested.explode_inner(df, "m", "u")) == [(1, 7), (1, 8)]
    assert rows(nested.explode_outer(df, "m", "u")) == [(1, 7), (1, 8), (2, None), (3, None)]
    assert rows(nested.explode_default(df, "m", "u")) == [(1, "7"), (1, "8"), (2, ""), (3, "")]


def test_split_pipe(spark):
    got = values(spark, ["a|b", "a", "", "a||b", "|a", "a|", "a||", None], nested.split_pipe)
    assert got == [["a", "b"], ["a"], [], ["a", "", "b"], ["", "a"], ["a"], ["a", ""], None]
    assert values(spark, ["a.b|c"], lambda c: nested.split_pipe(c, ".")) == [["a", "b|c"]]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.joined_text(F.lit("a"), F.lit(None), F.lit(2)),
        scalars.either(F.lit(None).cast("boolean"), F.lit(1), F.lit(2)),
        scalars.part_rows(F.lit(1000), F.lit(60000.0)),
        scalars.part_rows(F.lit(1000), F.lit(20000.0)),
    ).first()
    assert tuple(row) == ("a_NA_2", None, 500, 1000)


def test_offsets_become_utc(spark):
    texts = ["2024-01-05T10:00:00Z", "2024-01-05T12:00:00+02:00", "2024-01-05 04:30:00.0-0530", "2024-01-05T10:00:00", "2024-01-05 x+02:00"]
    ten = dt.datetime(2024, 1, 5, 10)
    assert values(spark, texts, lambda c: parse_as(c, "DATETIME", True)) == [ten] * 4 + [None]
    df = spark.createDataFrame([(t,) for t in texts[:4]], "t string")
    assert inferred_columns(df) == [("t", "DATETIME")]


def test_numbers_that_a_type_would_change_stay_text(spark):
    data = [("01234", "12345678901234567890", "9007199254740993", "0", "-0.5", "007.5", "1"), ("1", "1", "1.5", "-17", "0.25", "1", "9007199254740993")]
    df = spark.createDataFrame(data, ", ".join(f"c{i} string" for i in range(7)))
    assert [t for _, t in inferred_columns(df, numbers=True)] == ["STRING", "STRING", "STRING", "LONG", "DOUBLE", "STRING", "LONG"]
