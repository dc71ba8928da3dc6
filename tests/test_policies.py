from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import policies as p
from tidemark.workloads import fixtures as fx
from tidemark.workloads.queries import QUERIES

RECORD = (
    "dataset_id string, id bigint, name string, users array<bigint>, "
    "filters array<struct<column:string,values:array<string>,operator:string,not:boolean>>"
)
DESIRED = "dataset_id string, policy_name string, policy_column string, user_id string, policy_value string"


def flt(column, *values, operator="EQUALS", negated=False):
    return (column, list(values), operator, negated)


def long_rows(records):
    out = set()
    for ds, pid, name, users, filters in records:
        if name is None or "AA - Restricted" in name or name == "All Rows":
            continue
        for u in [str(u) if u is not None else None for u in users or []] or [""]:
            for col, values, *_ in filters or [("", [""])]:
                for v in values or [""]:
                    out.add((ds, pid, name, col, u, v))
    return out


def expected_changes(records, desired):
    """Compares written-out rows, dataset by dataset."""
    out = set()
    for ds in {d[0] for d in desired if d[0]}:
        cur = {r for r in long_rows(records) if r[0] == ds}
        want = {d for d in desired if d[0] == ds}
        ids = {r[2]: r[1] for r in cur}
        cur_cols = {(r[1], r[2], r[3]) for r in cur}
        want_cols = {(d[1], d[2]) for d in want}
        out |= {("add", ds, None, n, c) for n, c in want_cols if (n, c) not in {k[1:] for k in cur_cols}}
        dels = {k for k in cur_cols if k[1:] not in want_cols}
        out |= {("delete", ds, *k) for k in dels}
        gone = {k[0] for k in dels}
        live = {r[1:] for r in cur if r[1] not in gone}
        cor = {(ids.get(d[1]), *d[1:]) for d in want}
        out |= {("update", ds, *r[:3]) for r in live ^ cor if r[0] is not None}
    return out


def random_case(rng):
    names = ["a", "b", "c", "All Rows", "AA - Restricted x", "d"]
    records, pid = [], 0
    for ds in ["x", "y", "z"]:
        for name in names:
            if rng.random() < 0.6:
                pid += 1
                users = rng.sample([1, 2, 10], rng.randint(0, 3))
                columns = rng.choice([["c1"], ["c1"], ["c2"], ["c1", "c2"], []])
                filters = [flt(c, v) for c in columns for v in rng.sample(["u", "v", "w"], rng.randint(1, 3))]
                records.append((ds, pid, name, users, filters))
    desired = []
    for ds, p_id, name, users, filters in records:
        if ds == "z" or rng.random() < 0.2 or name in names[3:5]:
            continue
        us = [str(u) for u in users] or [rng.choice(["", "5"])]
        for col, values, *_ in filters:
            desired += [(ds, name, col, u, v) for u in us for v in values if rng.random() < 0.93]
    for _ in range(rng.randint(1, 5)):
        desired.append((rng.choice(["x", "y", "", None, "new"]), rng.choice(["a", "n", None]), "c1", rng.choice(["1", "9"]), "u"))
    return records, desired + desired[:2]


@pytest.mark.parametrize("seed", range(6))
def test_changes_equal_written_out_comparison(spark, rows, seed):
    records, desired = random_case(random.Random(seed))
    r, d = spark.createDataFrame(records, RECORD), spark.createDataFrame(desired, DESIRED)
    want = expected_changes(records, desired)
    got = rows(p.policy_changes(r, d), "action", "dataset_id", "policy_id", "policy_name", "policy_column")
    assert got == sorted(want, key=repr)
    listed = rows(p.policy_changes(r, d, lists=True), "action", "dataset_id", "policy_id", "policy_name", "policy_column")
    assert listed == got
    assert rows(p.policy_adds(r, d)) == sorted(((a[1], a[3], a[4]) for a in want if a[0] == "add"), key=repr)
    assert rows(p.policy_deletes(r, d)) == sorted((a[1:] for a in want if a[0] == "delete"), key=repr)


def test_lists_are_in_first_seen_order(spark):
    desired = [("x", "a", "c", u, v) for u, v in [("2", "b"), ("1", "z"), ("1", "m"), ("2", "a"), ("10", None), (None, "q")]]
    d = spark.createDataFrame(desired, DESIRED)
    wide = p.policy_wide_desired(d).first()
    assert (wide["user_id"], wide["policy_value"]) == ("1|10|2|NA", "m|z|NA|a|b|q")
    plan = p.policy_plan(spark.createDataFrame([], RECORD), d).first()
    assert plan["action"] == "add"
    assert (plan["user_id"], plan["policy_value"]) == (wide["user_id"], wide["policy_value"])


def test_definition(spark):
    wide = spark.createDataFrame([("x", "a", "c", "7|x|12", "u|v"), ("x", "b", "c", "", "")], DESIRED)
    first, second = p.policy_definitions(wide).orderBy("policy_name").select("definition.*").collect()
    assert first["users"] == [7, None, 12]
    assert [f.asDict() for f in first["filters"]] == [
        {"column": "c", "values": [v], "operator": "EQUALS", "not": False} for v in "uv"
    ]
    assert (first["id"], first["type"], first["name"]) == (None, "user", "a")
    assert (second["users"], second["filters"], second["virtualUsers"], second["groups"]) == ([], [], [], [])


def test_extract_fills_empty_lists(spark, rows):
    records = spark.createDataFrame([("x", 1, "a", [], []), ("x", 2, "b", None, [flt("c", "u")]), ("x", 3, None, [1], [])], RECORD)
    assert rows(p.policy_extract(records)) == [("x", 1, "a", "", "", ""), ("x", 2, "b", "c", "", "u")]


def test_two_policies_of_one_name_are_refused(spark):
    records = spark.createDataFrame([("x", 1, "a", [1], [flt("c", "u")]), ("x", 2, "a", [1], [flt("c", "u")])], RECORD)
    desired = spark.createDataFrame([("x", "a", "c", "1", "u")], DESIRED)
    for plan in (p.policy_changes(records, desired), p.policy_desired_long(records, desired)):
        with pytest.raises(Exception, match="two policies are named a"):
            plan.collect()


def test_no_dataset_is_an_error(spark):
    records = spark.createDataFrame([], RECORD)
    with pytest.raises(ValueError):
        p.policy_plan(records, spark.createDataFrame([(None, "a", "c", "1", "u"), ("", "a", "c", "1", "u")], DESIRED))


def test_many_datasets_are_joined(spark, rows, monkeypatch):
    records, desired = random_case(random.Random(3))
    r, d = spark.createDataFrame(records, RECORD), spark.createDataFrame(desired, DESIRED)
    literal = rows(p.policy_changes(r, d))
    monkeypatch.setattr(p, "LITERAL_DATASETS", 1)
    assert rows(p.policy_changes(r, d)) == literal


@pytest.mark.parametrize("seed", range(3))
def test_applied_plan_leaves_nothing_to_do(spark, rows, tmp_path, seed):
    rng = random.Random(seed)
    records = [
        (ds, i * 10 + j, f"p{i}", rng.sample(range(9), 2), [flt("c", "u"), flt("c", "v")][: rng.randint(1, 2)])
        for j, ds in enumerate("xyz") for i in range(1, 6)
    ] + [("x", 99, "All Rows", [1], [])]
    desired = [
        (ds, f"p{i}", "c", str(u), v)
        for ds in "xy" for i in range(3, 9) for u in rng.sample(range(9), 2) for v in "uv"
    ]
    r, d = spark.createDataFrame(records, RECORD), spark.createDataFrame(desired, DESIRED)
    p.policy_plan(r, d).write.parquet(str(tmp_path / "plan"))
    p.policy_apply(r, spark.read.parquet(str(tmp_path / "plan"))).write.parquet(str(tmp_path / "after"))
    after = spark.read.parquet(str(tmp_path / "after"))
    assert p.policy_plan(after, d).count() == 0
    in_scope = rows(p.policy_extract(after).where("dataset_id <> 'z'"), "dataset_id", "policy_name", "policy_column", "user_id", "policy_value")
    assert in_scope == sorted(desired, key=repr)
    untouched = rows(p.policy_extract(after.where("dataset_id = 'z'")))
    assert untouched == sorted((x for x in long_rows(records) if x[0] == "z"), key=repr)
    assert after.where("name = 'All Rows'").count() == 1
    assert after.groupBy("id").count().where("count > 1").count() == 0


def test_no_pairs_are_written_out(spark):
    """A policy of 300 users and 300 values takes 600 items, not 90,000 pairs."""
    records = spark.createDataFrame([("x", 1, "a", list(range(300)), [flt("c", *[f"v{i}" for i in range(300)])])], RECORD)
    assert p._stored_items(records).count() == 600


ENFORCED = [
    ("d", 1, "one", [1, 2], [flt("k", "1", "2"), flt("s", "a")]),
    ("d", 2, "two", [1], [flt("s", "b")]),
    ("d", 3, "twin", [1], [flt("s", "b", "c")]),
    ("d", 4, "open", [3], []),
    ("other", 5, "else", [4], [flt("s", "b")]),
]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_enforce(spark, rows, limit):
    data = [(k, s) for k in (1, 2, 3, None) for s in ("a", "b", None)] * 2
    df = spark.createDataFrame(data, "k int, s string")
    records = spark.createDataFrame(ENFORCED, RECORD)
    see = lambda user, **kw: rows(p.policy_enforce(df, records, "d", user, literal_values=limit, **kw))
    bag = lambda test: sorted((r for r in data if test(*r)), key=repr)
    assert see(1) == bag(lambda k, s: (k in (1, 2) and s == "a") or s in ("b", "c"))
    assert see("2") == bag(lambda k, s: k in (1, 2) and s == "a")
    assert see(3) == bag(lambda k, s: True)
    assert see(4) == []
    assert see(4, enabled=False) == bag(lambda k, s: True)


def test_enforce_refuses_what_it_cannot_do(spark):
    df = spark.createDataFrame([(1,)], "k int")
    for filters in ([flt("k", "1", operator="GREATER_THAN")], [flt("k", "1", negated=True)], [flt("gone", "1")]):
        records = spark.createDataFrame([("d", 1, "a", [1], filters)], RECORD)
        with pytest.raises(ValueError):
            p.policy_enforce(df, records, "d", 1)


def test_enforce_pushes_literals_to_the_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s")).write.parquet(str(tmp_path / "t"))
    records = spark.createDataFrame(ENFORCED, RECORD)
    seen = p.policy_enforce(spark.read.parquet(str(tmp_path / "t")), records, "d", 2)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "In(k, [1,2])" in plan and "EqualTo(s,a)" in plan


@pytest.mark.parametrize("limit", [10_000, 0])
def test_enforce_is_one_result_however_it_runs(spark, rows, limit):
    df = spark.createDataFrame([(1, "a"), (-5, "b"), (10**18, "c"), (0, "d")], "k bigint, `s``x` string")
    odd = ["1", "--5", "-5", "²", "1" + "0" * 30, "01", "-0", None]
    records = spark.createDataFrame([("d", 1, "p", [1], [flt("k", *odd)]), ("d", 2, "q", [1], [flt("s`x", "d"), flt("k", "0", "7")])], RECORD)
    assert rows(p.policy_enforce(df, records, "d", 1, literal_values=limit)) == sorted([(1, "a"), (-5, "b"), (0, "d")], key=repr)
    for column, value in (("operator", None), ("not", None)):
        broken = spark.createDataFrame([("d", 1, "p", [1], [{"column": "k", "values": ["1"], "operator": "EQUALS", "not": False} | {column: value}])], RECORD)
        with pytest.raises(ValueError, match="EQUALS"):
            p.policy_enforce(df, broken, "d", 1, literal_values=limit)
    none = spark.createDataFrame([("d", 1, "p", [1], [{"column": "k", "values": None, "operator": "EQUALS", "not": False}])], RECORD)
    assert rows(p.policy_enforce(df, none, "d", 1, literal_values=limit)) == []


def test_enforce_takes_many_sets_of_columns(spark, rows):
    names = [f"c{i}" for i in range(15)]
    df = spark.createDataFrame([tuple(int(i == j) for j in range(15)) for i in range(15)], ", ".join(f"{n} int" for n in names))
    pairs = [(a, b) for a in range(15) for b in range(a)]
    filters = [[flt(names[a], "1"), flt(names[b], "0")] for a, b in pairs]
    records = spark.createDataFrame([("d", i, f"p{i}", [1], f) for i, f in enumerate(filters)], RECORD)
    assert len(pairs) == 105
    assert p.policy_enforce(df, records, "d", 1, literal_values=0).count() == 14
    assert p.policy_enforce(df, records, "d", 1).count() == 14


def test_enforce_holds_for_groups(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    records = spark.createDataFrame(
        [("d", 1, "a", [5], ["v9"], None, [flt("k", "1")]), ("d", 2, "b", [], [], ["7", "8"], [flt("k", "2")]), ("d", 3, "c", None, None, ["9"], [flt("k", "3")])],
        "dataset_id string, id int, name string, users array<int>, virtualUsers array<string>, groups array<string>, "
        "filters array<struct<column:string,values:array<string>,operator:string,not:boolean>>",
    )
    members = spark.createDataFrame([(7, 5), (8, 5), (9, 6)], "group_id int, user_id int")
    see = lambda user, m=members: rows(p.policy_enforce(df, records, "d", user, memberships=m))
    assert see(5) == [(1,), (2,)] and see(6) == [(3,)] and see("v9") == [(1,)] and see(4) == [] and see(5, None) == [(1,)]


def test_desired_from_dataset(spark):
    df = spark.createDataFrame([("x", "n", "c", 1, "v", 0)], ["Dataset ID", "Policy Name", "Policy Column", "User ID", "Policy Value", "More"])
    assert p.desired_from_dataset(df).columns == ["dataset_id", "policy_name", "policy_column", "user_id", "policy_value"]


def whole_case(rng):
    """Policies of 1 to 3 columns, values with ``|`` and missing ones, reserved and missing names."""
    names = ["a", "b|c", "All Rows", "AA - Restricted x", "d", "e"]
    values = ["u", "v|w", "", None, "1", "NA"]
    records = []
    for ds in "xyz":
        for name in names:
            if rng.random() < 0.6:
                columns = rng.sample(["c1", "c2", "c|3"], rng.randint(0, 3))
                filters = [flt(c, *rng.sample(values, rng.randint(1, 3))) for c in columns]
                if filters and rng.random() < 0.2:
                    filters[0] = flt("c1", "u", operator=rng.choice(["GREATER_THAN", None]))
                records.append((ds, len(records) * 7, name, rng.sample([1, 2, 10, None], rng.randint(0, 3)), filters))
    desired = []
    for ds in ["x", "y", "new"]:
        for name in [*names, "fresh", None]:
            if rng.random() < 0.8:
                users = rng.sample(["1", "2", "30", "x", None], rng.randint(1, 3))
                for c in rng.sample(["c1", "c2", "c|3"], rng.randint(1, 3)):
                    desired += [(ds, name, c, u, v) for u in users for v in rng.sample(values, rng.randint(1, 3))]
    return records, desired + desired[:3]


def product_of(desired):
    """What the desired rows come down to: per policy its users, and per column the values."""
    users, values = {}, {}
    for ds, name, c, u, v in desired:
        if name is not None and name != "All Rows" and "AA - Restricted" not in name:
            users.setdefault((ds, name), set()).add(u if u is not None and u.isdecimal() else None)
            values.setdefault((ds, name), set()).add((c, v))
    return {(*k, c, u, v) for k in users for u in users[k] for c, v in values[k]}


@pytest.mark.parametrize("seed", range(4))
def test_whole_policies_settle(spark, rows, tmp_path, seed):
    records, desired = whole_case(random.Random(seed))
    r, d = spark.createDataFrame(records, RECORD), spark.createDataFrame(desired, DESIRED)
    p.policy_plan(r, d).write.parquet(str(tmp_path / "plan"))
    plan = spark.read.parquet(str(tmp_path / "plan"))
    p.policy_apply(r, plan).write.parquet(str(tmp_path / "after"))
    after = spark.read.parquet(str(tmp_path / "after"))
    assert p.policy_plan(after, d).count() == 0
    extracted = p.policy_extract(after.where("dataset_id <> 'z'"))
    assert rows(extracted, "dataset_id", "policy_name", "policy_column", "user_id", "policy_value") == sorted(product_of(desired), key=repr)
    reserved = after.where("name = 'All Rows' OR name LIKE 'AA%' OR dataset_id = 'z'")
    assert sorted(map(repr, reserved.collect())) == sorted(
        map(repr, r.where("name = 'All Rows' OR name LIKE 'AA%' OR dataset_id = 'z'").collect())
    )
    assert after.groupBy("dataset_id", "name").count().where("count > 1").count() == 0
    assert after.groupBy("id").count().where("count > 1").count() == 0
    # A policy is changed in one way, and each of its rows has the one record.
    for policy in plan.groupBy("dataset_id", "policy_name").agg(
        F.count_distinct("action").alias("actions"), F.count_distinct(F.to_json("definition")).alias("records")
    ).collect():
        assert policy["actions"] == 1 and policy["records"] <= 1


def test_every_column_of_a_policy_is_kept(spark):
    """A user must not see more because one column's filter replaced the others."""
    r = spark.createDataFrame([("x", 1, "p", [1], [flt("c1", "a"), flt("c2", "b")])], RECORD)
    d = spark.createDataFrame([("x", "p", "c1", "1", "A"), ("x", "p", "c2", "1", "B"), ("x", "q", "c1", "2", "a|b"), ("x", "q", "c2", "2", None)], DESIRED)
    after = p.policy_apply(r, p.policy_plan(r, d)).orderBy("name").collect()
    assert [[(f["column"], f["values"]) for f in a["filters"]] for a in after] == [[("c1", ["A"]), ("c2", ["B"])], [("c1", ["a|b"]), ("c2", [None])]]
    df = spark.createDataFrame([("A", "B"), ("A", "x"), ("a|b", "x"), ("a|b", None)], "c1 string, c2 string")
    stored = p.policy_apply(r, p.policy_plan(r, d))
    assert p.policy_enforce(df, stored, "x", 1).collect() == [("A", "B")]
    assert p.policy_enforce(df, stored, "x", 2).collect() == []


def test_records_from_rows(spark):
    d = spark.createDataFrame([("x", "p", "c1", "7", "a|b"), ("x", "p", "c2", "12", "v")], DESIRED)
    found = p.policy_records(d).orderBy("policy_column").collect()
    assert [f["policy_column"] for f in found] == ["c1", "c2"]
    assert found[0]["definition"] == found[1]["definition"]
    assert found[0]["definition"]["users"] == [12, 7]


def test_all_sets_of_columns_are_one_join(spark, tmp_path):
    """100 sets over a dataset with a status-like column: one scan, one join."""
    names = [f"c{i}" for i in range(15)]
    spark.range(0, 3000).select(*[(F.col("id") % (2 + i)).cast("string").alias(n) for i, n in enumerate(names)], F.lit("hot").alias("status")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    sets = [(names[a], names[b]) for a in range(15) for b in range(a)][:100]
    records = spark.createDataFrame(
        [("d", i, f"p{i}", [1], [flt("status", "hot", "cold"), flt(x, "1"), flt(y, "0")]) for i, (x, y) in enumerate(sets)], RECORD
    )
    seen = p.policy_enforce(df, records, "d", 1, literal_values=0)
    want = df.where(" OR ".join(f"({x} = '1' AND {y} = '0')" for x, y in sets))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "ExistenceJoin" not in plan and plan.count("FileScan parquet") == 1
    assert sorted(seen.collect()) == sorted(want.collect())


def test_a_hot_value_is_split(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in conf}
    df = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    records = spark.createDataFrame([("d", 1, "p", [1], [flt("k", "hot", *[str(i) for i in range(500)])])], RECORD)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        seen = p.policy_enforce(df, records, "d", 1, literal_values=0)
        assert len(seen.collect()) == df.where("k = 'hot' OR id_of < 500".replace("id_of", "try_cast(k AS INT)")).count()
        assert "skew=true" in seen._jdf.queryExecution().executedPlan().toString().lower().replace("isskew", "skew")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("case", [random_case, whole_case])
def test_policies_beyond_a_task_come_out_alike(spark, rows, monkeypatch, case):
    """Policies placed whole, and some of them item by item."""
    records, desired = case(random.Random(1))
    r, d = spark.createDataFrame(records, RECORD), spark.createDataFrame(desired, DESIRED)
    found = []
    for limit in (1_000_000, 8):
        monkeypatch.setattr(p, "TASK_ROWS", limit)
        found.append([rows(f) for f in (p.policy_plan(r, d), p.policy_changes(r, d, lists=True), p.policy_records(d))])
    assert found[0] == found[1]


def test_policies_of_a_task_are_not_written_out_per_item(spark):
    """The desired rows are moved once, as they are, and merged where they land without sorting texts per item."""
    r = spark.createDataFrame([("x", 1, "a", [1, 2], [flt("c", "u", "v")])], RECORD)
    d = spark.createDataFrame([("x", "a", "c", str(u), v) for u in range(3) for v in "uvw"], DESIRED)
    for made in (p.policy_plan(r, d), p.policy_records(d), p.policy_updates(r, d)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_a_task_merges_so_many_rows(spark, monkeypatch):
    """More rows are placed in more tasks, whatever the session's number of them."""
    d = spark.range(0, 900).select(
        F.lit("x").alias("dataset_id"), F.col("id").cast("string").alias("policy_name"), F.lit("c").alias("policy_column"),
        F.lit("1").alias("user_id"), F.lit("v").alias("policy_value"),
    )
    monkeypatch.setattr(p, "TASK_ROWS", 50)
    assert ", 19)" in p.policy_records(d)._jdf.queryExecution().executedPlan().toString().replace(", REPARTITION", ") REPARTITION")
    assert p.policy_records(d).count() == 900


@pytest.fixture
def orders_of_lines(spark, tmp_path):
    """Tables of 40 orders with 1 to 5 lines, an order twice and one without lines, and missing keys."""
    orders = [(i % 39, i % 7, "FOP"[i % 3], 30000.0 + i, f"{1 + i % 3}-X") for i in range(40)] + [(None, 1, "F", 30000.0, "1-X"), (99, 1, "O", 30000.0, "2-X")]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(orders, schema).withColumn("o_orderdate", F.to_timestamp(F.lit("1995-03-01"))).write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(i, (i + j) % 6) for i in range(39) for j in range(1 + i % 5)] + [(None, 1), (3, None)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, 10.0 * i - 5) for i in range(6)], "s_suppkey bigint, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(i, 10.0 * i - 5) for i in range(7)], "c_custkey bigint, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_lines_are_joined_in_as_many_tasks_as_they_take(spark, rows, monkeypatch, orders_of_lines):
    """A join left to itself is merged into few tasks, which sort more the more lines there are."""
    listed = lambda: fx.stored_policies(spark, orders_of_lines).withColumn("users", F.sort_array("users"))
    few = rows(fx.desired_policies(spark, orders_of_lines)), rows(listed())
    monkeypatch.setattr(fx, "TASK_LINES", 9)
    lines = fx.table(spark, orders_of_lines, "lineitem").count()
    for made in (fx.desired_policies(spark, orders_of_lines), listed()):
        assert f"l_orderkey, {lines // 9 + 1})" in re.sub(r"#\d+L?", "", made._jdf.queryExecution().executedPlan().toString())
    assert (rows(fx.desired_policies(spark, orders_of_lines)), rows(listed())) == few


@pytest.mark.parametrize("name", ["policy_definitions", "policy_plan", "policy_updates"])
def test_desired_rows_are_joined_once(spark, orders_of_lines, name):
    """They are read several times, so they are written first: no line of an order is read again with them."""
    plan = QUERIES[name](spark, orders_of_lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "s_acctbal" not in plan


def test_policies_are_compared_once(spark):
    """The choice of the changed ones is not written out a second time below the comparison."""
    r = spark.createDataFrame([("x", 1, "a", [1, 2], [flt("c", "u", "v")])], RECORD)
    d = spark.createDataFrame([("x", "a", "c", str(u), v) for u in range(3) for v in "uvw"], DESIRED)
    plan = p.policy_plan(r, d)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "collect_" in line or "Filter" in line and "sort_array" in line]
