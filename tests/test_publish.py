from __future__ import annotations

import gzip
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators.schema import schema_changes
from tidemark.sources import datasets, publish, storage
from tidemark.streaming.upserts import stream_upsert
from tests.conftest import DATA

AWKWARD = [("a,b", 1), ('say "hi"', 2), ("two\nlines", 3), ("  blanks ", 4), ("", 5), (None, None), ("back\\slash", 7), ("ünï", 8)]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "data")


def test_csv_parts_round_trip(spark, rows, path):
    df = spark.createDataFrame(AWKWARD, "t string, i int")
    publish.write_csv_parts(df, path, rows_per_part=3)
    assert rows(datasets.scan_csv(spark, path, df.schema, header=False)) == rows(df)
    for part in Path(path).glob("part-*"):
        assert part.suffix == ".gz"
        text = gzip.decompress(part.read_bytes()).decode()
        assert not text.startswith("t,i")


def test_csv_part_size(spark, path):
    df = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 99, "x").alias("t"))
    for fraction in (0.2, 0.01, None):
        assert publish.estimate_part_rows(df, target_kb=50, sample_fraction=fraction) in (499, 500)
    assert publish.estimate_part_rows(df.limit(0)) == 0
    publish.write_csv_parts(df.coalesce(2), path, rows_per_part=500)
    sizes = [gzip.decompress(f.read_bytes()).count(b"\n") for f in Path(path).glob("part-*")]
    assert sum(sizes) == 10_000 and max(sizes) <= 500 and len(sizes) == 20


def test_empty_table_gives_empty_dataset(spark, path):
    df = spark.createDataFrame([], "t string, i int")
    publish.write_csv_parts(df, path + "/csv")
    assert datasets.scan_csv(spark, path + "/csv", df.schema, header=False).count() == 0
    for keys in ([], ["i"]):
        publish.publish_replace(df, path + "/p", keys)
        assert publish.read_published(spark, path + "/p").columns == ["t", "i"]
        assert publish.read_published(spark, path + "/p").count() == 0


def test_readers_see_old_or_new(spark, path):
    publish.publish_replace(spark.range(5), path)
    upload = publish.start_upload(spark.range(7), path)
    assert publish.read_published(spark, path).count() == 5
    publish.commit_upload(spark, upload)
    assert publish.read_published(spark, path).count() == 7
    upload = publish.start_upload(spark.range(9), path)
    publish.abort_upload(spark, upload)
    assert publish.read_published(spark, path).count() == 7
    assert len(storage.children(spark, path + "/versions")) == 2
    assert publish.purge_versions(spark, path) == 1
    assert publish.read_published(spark, path).count() == 7


def test_failed_upload_leaves_nothing(spark, path):
    publish.publish_replace(spark.range(5), path)
    with pytest.raises(RuntimeError, match="expected"):
        publish.publish_replace(spark.range(3), path, expected_rows=4)
    with pytest.raises(Exception, match="boom"):
        publish.publish_replace(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert publish.read_published(spark, path).count() == 5
    assert len(storage.children(spark, path + "/versions")) == 1


def test_second_writer_is_refused(spark, path):
    publish.publish_replace(spark.range(5), path)
    first, second = publish.start_upload(spark.range(6), path), publish.start_upload(spark.range(7), path)
    publish.commit_upload(spark, first)
    with pytest.raises(publish.ConflictError):
        publish.commit_upload(spark, second)
    assert publish.read_published(spark, path).count() == 6


def test_nothing_published(spark, path):
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    with pytest.raises(FileNotFoundError):
        publish.publish_update(spark.range(1), path)


def test_upsert(spark, rows, path):
    schema = "k int, j string, v int"
    publish.publish_replace(spark.createDataFrame([(1, "a", 1), (1, None, 2), (None, "a", 3), (2, "b", 4)], schema), path, ["k", "j"], buckets=4)
    batch = spark.createDataFrame([(1, None, 20, 1), (1, None, 21, 2), (9, "z", 9, 1), (None, "a", 30, 1)], schema + ", seq int")
    assert publish.publish_upsert(batch, path, ["k", "j"], ["seq"])
    want = [(1, "a", 1), (1, None, 21), (2, "b", 4), (9, "z", 9), (None, "a", 30)]
    assert rows(publish.read_published(spark, path)) == sorted(want, key=repr)


def test_awkward_column_names(spark, rows, path):
    df = spark.createDataFrame([(1, 5, "a", 1)], ["the key", "k.2", "a.b", "e`f"])
    keys = ["the key", "k.2"]
    publish.publish_replace(df, path, keys, buckets=2)
    publish.publish_upsert(df.withColumn("a.b", F.lit("z")), path, keys, ["a.b"])
    assert rows(publish.read_published(spark, path)) == [(1, 5, "z", 1)]
    publish.write_csv_parts(df, path + "-csv")
    assert rows(datasets.scan_csv(spark, path + "-csv", df.schema, header=False)) == [(1, 5, "a", 1)]


def test_upsert_rewrites_only_touched_buckets(spark, path):
    base = spark.range(1000).withColumn("v", F.lit(0))
    publish.publish_replace(base, path, ["id"], buckets=16)
    before = publish.read_state(spark, path).parts
    publish.publish_upsert(spark.createDataFrame([(5, 1)], base.schema), path, ["id"], ["v"])
    after = publish.read_state(spark, path).parts
    assert sum(before[b] != after[b] for b in before) == 1
    assert publish.read_published(spark, path).where("v = 1").count() == 1
    assert publish.read_published(spark, path).count() == 1000
    publish.purge_versions(spark, path)
    assert publish.read_published(spark, path).count() == 1000


def test_upsert_creates_and_skips_replays(spark, rows, path):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([(1, "b")], "k int, v string")
    assert publish.publish_upsert(one, path, ["k"], ["v"], batch_id=("s", 0))
    assert publish.publish_upsert(two, path, ["k"], ["v"], batch_id=("s", 1))
    assert not publish.publish_upsert(one, path, ["k"], ["v"], batch_id=("s", 0))
    assert rows(publish.read_published(spark, path)) == [(1, "b")]
    assert publish.publish_upsert(one, path, ["k"], ["v"], newest_wins=True)
    assert rows(publish.read_published(spark, path)) == [(1, "b")]


@pytest.mark.parametrize("keys", [None, [], "k", [None], [""]])
def test_upsert_needs_keys(spark, path, keys):
    with pytest.raises(ValueError):
        publish.publish_upsert(spark.range(1), path, keys, ["id"])


def test_update_reports_schema_changes(spark, path):
    publish.publish_replace(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    with pytest.warns(UserWarning, match="Schema changed"):
        changes = publish.publish_update(spark.createDataFrame([("b", 2.5)], "v string, k double"), path)
    assert [c[0] for c in changes] == ["retyped", "moved", "moved"]
    assert publish.read_published(spark, path).columns == ["v", "k"]
    assert publish.publish_update(spark.createDataFrame([("c", 1.5)], "v string, k double"), path) == []


def test_schema_changes():
    old = [("a", "LONG"), ("b", "STRING"), ("c", "DATE")]
    assert schema_changes(old, old) == []
    assert schema_changes(old, old[1:]) == [("removed", "a", "LONG", None)]
    assert schema_changes(old, [*old, ("d", "LONG")]) == [("added", "d", None, "LONG")]


def test_stream_upsert(spark, rows, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.repartition(4, "event_id").write.parquet(str(tmp_path / "in"))
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = stream_upsert(stream, path, ["user_id"], ["ts", "event_id"], checkpoint, buckets=4)
        query.awaitTermination()
        return query.id

    query_id = run()
    state = publish.read_state(spark, path)
    assert state.batches == {query_id: 3}
    last = events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert rows(publish.read_published(spark, path), "user_id", "event_id") == rows(last)
    assert run() == query_id
    assert publish.read_state(spark, path) == state
    checkpoint = str(tmp_path / "fresh")
    run()
    assert len(publish.read_state(spark, path).batches) == 2
    assert rows(publish.read_published(spark, path), "user_id", "event_id") == rows(last)


def test_types_survive_publishing(spark, path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' t, array(named_struct('x', 1)) a, cast(1.5 as decimal(5,2)) d")
    publish.publish_replace(df, path, ["t"])
    assert publish.read_published(spark, path).collect() == df.collect()
    assert isinstance(publish.read_published(spark, path).schema["t"].dataType, T.TimestampNTZType)


def test_a_write_between_read_and_commit_is_refused(spark, tmp_path):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.range(3), path)
    seen = publish.read_state(spark, path)
    publish.publish_replace(spark.range(4), path)
    with pytest.raises(publish.ConflictError):
        publish.publish_replace(spark.range(5), path, expected_revision=seen.revision)
    assert publish.read_published(spark, path).count() == 4


def test_a_revision_is_created_once(spark, tmp_path):
    path = str(tmp_path / "d")
    one, two = publish.start_upload(spark.range(1), path), publish.start_upload(spark.range(2), path)
    later = publish.read_state
    try:
        publish.read_state = lambda *_: None  # both look before either writes
        publish.commit_upload(spark, one)
        with pytest.raises(publish.ConflictError):
            publish.commit_upload(spark, two)
    finally:
        publish.read_state = later
    assert publish.read_published(spark, path).count() == 1


def test_a_state_not_written_to_its_end_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.range(3), path)
    (tmp_path / "d" / "state-000000000002.json").write_text("{")
    assert publish.read_published(spark, path).count() == 3


def test_purge_spares_open_uploads(spark, tmp_path):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.range(3), path)
    publish.publish_replace(spark.range(4), path)
    upload = publish.start_upload(spark.range(5), path)
    assert publish.purge_versions(spark, path) == 1
    publish.commit_upload(spark, upload)
    assert publish.read_published(spark, path).count() == 5
    lost = publish.start_upload(spark.range(6), path)
    assert publish.purge_versions(spark, path, abandoned=True) == 2
    with pytest.raises(publish.ConflictError):
        publish.commit_upload(spark, lost)
    assert publish.read_published(spark, path).count() == 5


def test_upserts_fit_the_stored_schema(spark, tmp_path):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])
    wider = spark.createDataFrame([(1, "b", 1), (2, "c", 1)], "k bigint, v string, seq int")
    publish.publish_upsert(wider, path, ["k"], ["seq"])
    assert sorted(map(tuple, publish.read_published(spark, path).collect())) == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError, match="extra"):
        publish.publish_upsert(wider.withColumnRenamed("seq", "extra"), path, ["k"], ["k"])
    with pytest.raises(Exception, match="does not fit int"):
        publish.publish_upsert(spark.createDataFrame([(1 << 40, "d", 1)], wider.schema), path, ["k"], ["seq"])
    with pytest.raises(ValueError, match="keyed"):
        publish.publish_update(spark.createDataFrame([("a",)], "v string"), path)
    assert sorted(map(tuple, publish.read_published(spark, path).collect())) == [(1, "b"), (2, "c")]


def bytes_below(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_delta_is_as_large_as_its_batch(spark, rows, path):
    base = spark.range(0, 40_000, 1, 2).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    publish.publish_replace(base, path, ["id"])
    stored = bytes_below(path)
    batch = base.where("id % 100 = 0").withColumn("v", F.lit("new")).withColumn("seq", F.lit(1))
    publish.publish_upsert(batch, path, ["id"], ["seq"], as_delta=True)
    assert bytes_below(path) - stored < stored * 0.02
    assert publish.read_state(spark, path).parts and len(publish.read_state(spark, path).deltas) == 1
    want = rows(base.withColumn("v", F.when(F.col("id") % 100 == 0, "new").otherwise(F.col("v"))))
    assert rows(publish.read_published(spark, path)) == want
    assert publish.compact(spark, path).deltas == []
    assert rows(publish.read_published(spark, path)) == want
    assert publish.compact(spark, path) is None
    publish.purge_versions(spark, path)
    assert rows(publish.read_published(spark, path)) == want


@pytest.mark.parametrize("newest_wins", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_read_like_rewritten_buckets(spark, rows, tmp_path, seed, newest_wins):
    """The same batches as deltas, with compactions in between, and with every batch rewriting its buckets."""
    rng = random.Random(seed)
    schema = "k int, j string, seq int, v int"
    draw = lambda n: list({(k, j): (k, j, rng.randint(0, 9), rng.randint(0, 999)) for k, j in [
        (rng.choice([None, *range(40)]), rng.choice(["a", None])) for _ in range(n)]}.values())
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    first = spark.createDataFrame(draw(60), schema)
    for at in (one, two):
        publish.publish_replace(first, at, ["k", "j"], buckets=3)
    for number in range(5):
        batch = spark.createDataFrame(draw(15), schema)
        publish.publish_upsert(batch, one, ["k", "j"], ["seq"], newest_wins=newest_wins, as_delta=True, batch_id=("s", number))
        publish.publish_upsert(batch, two, ["k", "j"], ["seq"], newest_wins=newest_wins, batch_id=("s", number))
        a, b = (publish.read_published(spark, at) for at in (one, two))
        # Rows that are alike in key and order may differ in what a rewrite keeps of them.
        columns = ["k", "j", "seq"] if newest_wins else ["k", "j", "seq", "v"]
        assert rows(a, *columns) == rows(b, *columns)
        if number == 2:
            assert publish.compact(spark, one, bucket_bytes=500).buckets > 3
            assert rows(publish.read_published(spark, one), *columns) == rows(b, *columns)
    assert not publish.publish_upsert(batch, one, ["k", "j"], ["seq"], newest_wins=newest_wins, as_delta=True, batch_id=("s", 4))
    # A batch of the other kind finds the deltas merged.
    publish.publish_upsert(batch, one, ["k", "j"], ["seq"], newest_wins=not newest_wins, as_delta=True)
    assert len(publish.read_state(spark, one).deltas) == 1


def test_buckets_split_in_turn(spark, rows, path):
    base = spark.range(3000).withColumn("v", F.lit(0))
    publish.publish_replace(base, path, ["id"], buckets=3)
    seen = [3]
    for _ in range(4):
        before = publish.read_state(spark, path).parts
        state = publish.compact(spark, path, bucket_bytes=3500)
        if state is None:
            break
        seen.append(state.buckets)
        assert len(state.parts) == state.buckets
        if state.buckets < 2 * len(before):  # the others stay as they are
            assert any(before[b] == v for b, v in state.parts.items() if b in before)
    assert seen[-1] > 3 and seen == sorted(set(seen))
    for b, v in publish.read_state(spark, path).parts.items():
        own = spark.read.parquet(publish._part_folder(path, v, b))
        last = publish.read_state(spark, path)
        assert {r[0] for r in own.select(publish._bucket(["id"], last.buckets, last.first_buckets)).distinct().collect()} == {int(b)}
    assert rows(publish.read_published(spark, path)) == rows(base)
    publish.publish_upsert(spark.createDataFrame([(5, 1), (9999, 1)], base.schema), path, ["id"], ["v"])
    assert publish.read_published(spark, path).agg(F.count("id"), F.sum("v")).first() == (3001, 2)


def test_a_torn_state_file_blocks_nobody(spark, tmp_path):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.range(3), path, ["id"])
    (tmp_path / "d" / "state-000000000002.json").write_text("")
    publish.publish_upsert(spark.range(5), path, ["id"], ["id"])
    assert publish.read_published(spark, path).count() == 5
    (tmp_path / "d" / "state-000000000004.json").write_text("{")
    publish.publish_replace(spark.range(7), path)
    assert publish.read_published(spark, path).count() == 7
    publish.purge_versions(spark, path)
    assert publish.read_published(spark, path).count() == 7


def test_a_claim_holds_until_its_writer_is_dead(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    publish.publish_replace(spark.range(3), path)
    assert storage.create_text(spark, f"{path}/claims/000000000002-000", "someone")
    with pytest.raises(publish.ConflictError):
        publish.publish_replace(spark.range(4), path)
    monkeypatch.setattr(publish, "CLAIM_SECONDS", 0.0)
    publish.publish_replace(spark.range(5), path)
    assert publish.read_published(spark, path).count() == 5
    # The one who was taken for dead comes back.
    late = publish.Upload(path, "x", publish.State(schema=spark.range(1).schema.json(), revision=2, previous=1), 0)
    with pytest.raises(publish.ConflictError):
        publish.commit_upload(spark, late)
    assert publish.read_published(spark, path).count() == 5


def test_micro_batches_write_what_they_bring(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sources.publish.MOST_DELTAS", 100)
    path = str(tmp_path / "out")
    wide = spark.range(0, 50_000, 1, 2).select("id", F.lit(0).alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    publish.publish_replace(wide, path, ["id"])
    stored = bytes_below(path)
    for i in range(3):
        wide.where(f"id % 500 = {i}").withColumn("seq", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(wide.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    stream_upsert(stream, path, ["id"], ["seq"], str(tmp_path / "state")).awaitTermination()
    assert len(publish.read_state(spark, path).deltas) == 3
    assert bytes_below(path) - stored < 0.05 * stored
    assert publish.read_published(spark, path).agg(F.count("id"), F.sum("seq")).first() == (50_000, 300)
