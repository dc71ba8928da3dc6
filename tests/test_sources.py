from __future__ import annotations

import csv
import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import friendly_names
from tidemark.session import scratch_dir
from tidemark.sources import csvrecords, datasets
from tidemark.sources.publish import publish_replace, publish_upsert, read_published


def test_csv_with_awkward_header(spark, tmp_path):
    (tmp_path / "d.csv").write_text('a,A,"b ""c""",When,Day,n,x\n1,\\N,"l1\nl2",2024-01-05T10:00:00,2024-1-5,1.5,01\n2,z,\\N,2024-01-06 11:00:00.25,\\N,-3,x\n')
    with pytest.warns(UserWarning, match="1 repeated"):
        df = datasets.scan_csv(spark, str(tmp_path / "d.csv"), friendly=True)
    assert df.dtypes == [("a", "bigint"), ("a_2", "string"), ("b__c_", "string"), ("when", "timestamp_ntz"), ("day", "date"), ("n", "double"), ("x", "string")]
    first, second = [tuple(str(v) if v is not None else None for v in r) for r in df.orderBy("a").collect()]
    assert first == ("1", None, "l1\nl2", "2024-01-05 10:00:00", "2024-01-05", "1.5", "01")
    assert second == ("2", "z", None, "2024-01-06 11:00:00.250000", None, "-3.0", "x")


def test_csv_names_stay_without_friendly(spark, tmp_path):
    (tmp_path / "d.csv").write_text("Policy Name,b\nx,1\n")
    assert datasets.scan_csv(spark, str(tmp_path / "d.csv")).columns == ["Policy Name", "b"]


def test_json_page_files(spark, rows, tmp_path):
    for i, page in enumerate(([{"id": 1, "m": [1, 2]}, {"id": 2}], [{"id": 3, "m": []}], [])):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    df = datasets.scan_json_pages(spark, str(tmp_path), "id bigint, m array<bigint>")
    assert rows(df) == [(1, [1, 2]), (2, None), (3, [])]


def test_unreadable_page_fails(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"id": 1}, {"id":')
    with pytest.raises(Exception):
        datasets.scan_json_pages(spark, str(tmp_path), "id bigint").collect()


def test_listing(spark, rows, tmp_path):
    spark.range(5).repartition(2).write.parquet(str(tmp_path / "b set"))
    spark.range(3).withColumn("x", F.lit("a")).write.partitionBy("x").parquet(str(tmp_path / "a+1"))
    spark.range(0).write.parquet(str(tmp_path / "c"))
    listing = datasets.dataset_listing(spark, str(tmp_path))
    assert [tuple(r) for r in listing.collect()] == [("a+1", 2, 3), ("b set", 1, 5), ("c", 1, 0)]
    assert [r["name"] for r in datasets.dataset_listing(spark, str(tmp_path), limit=1, offset=1).collect()] == ["b set"]


def test_dataset_sql_keeps_to_itself(spark, rows, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a"))
    spark.range(9).write.parquet(str(tmp_path / "b"))
    a = datasets.dataset_sql(spark, "SELECT count(*) AS n FROM table", str(tmp_path / "a"))
    b = datasets.dataset_sql(spark, "SELECT `id` FROM table WHERE id > 6", str(tmp_path / "b"))
    assert (rows(a), rows(b)) == ([(5,)], [(7,), (8,)])
    publish_replace(spark.range(4), str(tmp_path / "p"))
    assert rows(datasets.dataset_sql(spark, "SELECT max(id) FROM table", str(tmp_path / "p"), read_published)) == [(3,)]
    assert "table" not in [t.name for t in spark.catalog.listTables()]
    assert rows(datasets.sql_rows_json(b)) == [(["7"],), (["8"],)]


def test_friendly_names():
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert friendly_names(["Policy Name", "1st", "", "_x", "é.y"]) == ["policy_name", "x1st", "x", "x_x", "é_y"]
    with pytest.warns(UserWarning, match="3 repeated"):
        assert friendly_names(["a", "A", "a_2", "a", "a 2"]) == ["a", "a_3", "a_2", "a_4", "a_2_2"]


def test_scratch_is_shared_and_fresh(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(root)


def test_records_of_another_width_are_not_changed(spark, tmp_path):
    (tmp_path / "d.csv").write_text('a,b\n1,x\n2,y,EXTRA\n3\n4,"p\nq"\n5,\n')
    path = str(tmp_path / "d.csv")
    with pytest.raises(Exception, match="not 2 cells"):
        datasets.scan_csv(spark, path).collect()
    df = datasets.scan_csv(spark, path, bad_records="raw")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (1, "x", None), (2, "y", "2,y,EXTRA"), (3, None, "3"), (4, "p\nq", None), (5, "", None)
    ]
    typed = datasets.scan_csv(spark, path, spark.createDataFrame([], "a int, b string").schema, bad_records="raw")
    assert typed.where("raw IS NOT NULL").count() == 2


def test_codes_and_long_ids_are_not_changed(spark, tmp_path):
    (tmp_path / "d.csv").write_text("zip,id,n\n01234,12345678901234567890,1\n99999,1,2\n")
    assert datasets.scan_csv(spark, str(tmp_path / "d.csv")).collect() == [("01234", "12345678901234567890", 1), ("99999", "1", 2)]


def test_listing_of_published_datasets(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    publish_replace(spark.range(7).withColumn("v", F.lit(1)), str(tmp_path / "keyed"), ["id"], buckets=3)
    publish_replace(spark.range(9), str(tmp_path / "whole"))
    publish_replace(spark.range(2), str(tmp_path / "whole"))
    late = str(tmp_path / "late")
    publish_replace(spark.range(5).withColumn("v", F.lit(0)), late, ["id"], buckets=2)
    publish_upsert(spark.range(3, 8).withColumn("v", F.lit(1)), late, ["id"], ["v"], as_delta=True)
    publish_replace(spark.range(0), str(tmp_path / "empty"), ["id"])
    want = [("empty", 1, 0), ("keyed", 2, 7), ("late", 2, 8), ("plain", 1, 4), ("whole", 1, 2)]
    assert [tuple(r) for r in datasets.dataset_listing(spark, str(tmp_path)).collect()] == want
    assert [tuple(r) for r in datasets.dataset_listing(spark, str(tmp_path), limit=2, offset=1).collect()] == want[1:3]


@pytest.fixture
def small_ranges(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for c, v in before.items():
        spark.conf.set(c, v)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_texts_with_line_breaks_are_read_in_ranges(spark, rows, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    pieces = ["x", '"', ",", "\n", "\r\n", "\n\n", "é", " ", "long text " * 30]
    made = [(str(i), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))), rng.choice(["a", "b\nc"])) for i in range(400)]
    with open(tmp_path / "d.csv", "w", newline="") as out:
        writer = csv.writer(out, quoting=csv.QUOTE_ALL if seed == 2 else csv.QUOTE_MINIMAL, lineterminator="\r\n" if seed == 3 else "\n")
        writer.writerows([("i", "text\nof", "k"), *made])
    lines = csvrecords.placed_lines(spark, str(tmp_path / "d.csv"))
    assert lines.select("block").distinct().count() > 10
    df = datasets.scan_csv(spark, str(tmp_path / "d.csv"))
    assert df.columns == ["i", "text\nof", "k"]
    assert rows(df) == sorted(((int(i), t, k) for i, t, k in made), key=repr)


def test_files_are_read_by_their_own_headers(spark, rows, tmp_path, small_ranges):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text('a,b,a\n1,"x\ny",2\n')
    (tmp_path / "d" / "2.csv").write_text("a,a,b\n3,4,z\n")
    (tmp_path / "d" / "3.csv").write_text("\nb,c\nw,5\n")
    (tmp_path / "d" / "4.csv").write_text("")
    with pytest.warns(UserWarning):
        df = datasets.scan_csv(spark, str(tmp_path / "d"), friendly=True)
    assert df.columns == ["a", "b", "a_2", "c"]
    assert rows(df) == sorted([(1, "x\ny", 2, None), (3, "z", 4, None), (None, "w", None, 5)], key=repr)
