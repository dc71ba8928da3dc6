"""One registered query per operator; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import scalars
from tidemark.functions.names import with_friendly_names
from tidemark.functions.servicetypes import parse_user_time
from tidemark.operators import changes, nested, relational, schema
from tidemark.operators.numbering import number_rows
from tidemark.plans import policies, projects
from tidemark.session import scratch_dir, written
from tidemark.sources import datasets, publish
from tidemark.streaming.upserts import stream_upsert
from tidemark.workloads import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The window of the audit query.
WINDOW = ("2024-01-05 00:00:00", "2024-01-10 00:00:00")
STAFF_USER = 3
TRADING_REGION = "ASIA"


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# -- scans -----------------------------------------------------------------------


@registered
def scan_dataset_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    fx.table(spark, sf_dir, "orders").write.options(**datasets.write_options(header=True)).csv(path)
    return datasets.scan_csv(spark, path)


@registered
def scan_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = fx.table(spark, sf_dir, "conversations")
    path = scratch_dir(spark, "pages")
    fx.write_json_pages(talks, path, page_size=50)
    return datasets.scan_json_pages(spark, path, talks.schema, page_per_line=True)


@registered
def dataset_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.dataset_schema(fx.table(spark, sf_dir, "orders"))


@registered
def dataset_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.dataset_listing(spark, sf_dir)


# -- sinks -----------------------------------------------------------------------


@registered
def write_csv_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    path = scratch_dir(spark, "parts")
    publish.write_csv_parts(orders, path)
    return datasets.scan_csv(spark, path, orders.schema, header=False)


@registered
def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "replace")
    publish.publish_replace(fx.table(spark, sf_dir, "customer"), path)
    publish.publish_replace(fx.table(spark, sf_dir, "orders"), path, keys=["o_orderkey"])
    publish.abort_upload(spark, publish.start_upload(fx.table(spark, sf_dir, "lineitem"), path))
    return publish.read_published(spark, path)


@registered
def publish_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "upsert")
    publish.publish_replace(customers, path, keys=["c_custkey"])
    cleared = customers.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0)).withColumn("seq", F.lit(1))
    new = fx.table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"), F.lit(1).alias("seq"),
    )
    older = cleared.withColumn("c_name", F.lit("outdated")).withColumn("seq", F.lit(0))
    publish.publish_upsert(cleared.unionByName(new).unionByName(older), path, ["c_custkey"], ["seq"], as_delta=True)
    return publish.read_published(spark, path)


@registered
def publish_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    path = scratch_dir(spark, "update")
    publish.publish_replace(parts, path)
    publish.publish_update(parts.withColumn("p_large", F.col("p_size") > 25), path)
    return publish.read_published(spark, path)


def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream")
    events = fx.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream_upsert(
        stream, f"{path}/data", ["user_id"], ["ts", "event_id"], checkpoint=f"{path}/checkpoint"
    ).awaitTermination()
    return publish.read_published(spark, f"{path}/data")


QUERIES["stream_upsert"] = _stream_upsert


# -- projections and filters -------------------------------------------------------


@registered
def dataset_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = "SELECT event_type, count(*) AS n, max(value) AS top FROM table WHERE value > 1 GROUP BY event_type"
    return datasets.dataset_sql(spark, query, f"{sf_dir}/events.parquet")


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").withColumn("o_day", F.col("o_orderdate").cast("date"))
    return orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])


@registered
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _order_texts(spark, sf_dir)
    return schema.infer_types(texts.withColumn("o_size", F.length("o_orderpriority")))


@registered
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = schema.columns_of(fx.table(spark, sf_dir, "orders"))
    incoming = _order_texts(spark, sf_dir).select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.concat("o_totalprice", F.lit(" USD")).alias("o_totalprice"),
        "o_day", "o_orderdate",
    )
    return schema.schema_diff(spark, stored, schema.inferred_columns(incoming, numbers=True))


@registered
def cast_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoiled = F.col("o_orderstatus") == "P"
    texts = _order_texts(spark, sf_dir).select(
        "o_orderkey",
        F.when(spoiled, "n/a").otherwise(F.col("o_totalprice")).alias("price"),
        F.when(spoiled, F.col("o_totalprice")).otherwise(F.col("o_custkey")).alias("whole"),
        F.when(spoiled, F.translate("o_day", "-", "/")).otherwise(F.col("o_day")).alias("day"),
        F.when(spoiled, F.col("o_orderdate")).otherwise(F.translate("o_orderdate", " ", "T")).alias("time"),
        F.col("o_orderstatus").alias("status"),
    )
    return schema.cast_typed(
        texts,
        {"o_orderkey": "LONG", "price": "DOUBLE", "whole": "LONG", "day": "DATE", "time": "DATETIME", "status": "STRING"},
    )


@registered
def friendly_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part").toDF(
        "Part Key", "Part Name", "part.name", "part_name_2", "1size", "Price ($)"
    )
    return with_friendly_names(parts)


@registered
def select_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {short: long for long, short in policies.DESIRED_NAMES.items()}
    dataset = relational.rename_columns(fx.wished_policies(spark, sf_dir), named).withColumn("Note", F.lit("x"))
    return relational.select_named(dataset, list(policies.DESIRED_NAMES))


@registered
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.rename_columns(fx.project_lists(spark, sf_dir), projects.LIST_NAMES)


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "").when(F.col("event_type") != "view", F.col("event_type"))
    return fx.table(spark, sf_dir, "events").select("event_id", "user_id", kind.alias("kind"))


@registered
def filter_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.filter_present(_gappy_events(spark, sf_dir), "kind")


@registered
def filter_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.filter_excluded(fx.record_policies(spark, sf_dir), "name").select("dataset_id", "id", "name")


@registered
def activity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.activity_window(fx.activity(spark, sf_dir), *WINDOW)


@registered
def lookup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.lookup_by_key(fx.table(spark, sf_dir, "orders"), "o_orderpriority", "1-URGENT")


@registered
def mark_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.mark_constant(fx.table(spark, sf_dir, "customer"), "cur")


# -- joins -----------------------------------------------------------------------


@registered
def join_left_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority")
    finished = orders.where("o_orderstatus = 'F'").groupBy(priority).agg(F.count(F.lit(1)).alias("finished"))
    known = finished.where(~F.col("priority").eqNullSafe("2-HIGH"))
    return relational.join_left(orders.select("o_orderkey", priority), known, ["priority"])


@registered
def join_full_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey")
    )
    owing = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("custkey")
    customers = fx.table(spark, sf_dir, "customer").groupBy(owing).agg(F.count(F.lit(1)).alias("customers"))
    return relational.join_full(orders, customers, ["custkey"])


@registered
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.stored_policies(spark, sf_dir).select("dataset_id", F.col("name").alias("policy_name"))
    return relational.join_anti(fx.desired_policies(spark, sf_dir), stored, ["dataset_id", "policy_name"])


@registered
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array("o_custkey", F.month("o_orderdate").cast("bigint")).alias("users"),
        F.array("o_orderstatus", "o_orderpriority").alias("values"),
    )
    return relational.pair_lists(orders, "users", "values", ("user", "value"))


# -- aggregates, sorting, stacking ---------------------------------------------------


@registered
def agg_ordered_distinct_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"),
    )
    return relational.ordered_distinct_concat(
        lines, ["l_orderkey"], ["l_suppkey", "l_returnflag", "l_linestatus"], ["l_linenumber", "l_partkey", "l_suppkey"]
    )


@registered
def agg_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.repeat_summary(fx.table(spark, sf_dir, "events"), ["user_id", "event_type"])


@registered
def window_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return number_rows(events, ["user_id"], ["ts", "event_id"])


@registered
def sort_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sort_rows(_gappy_events(spark, sf_dir), ["kind", "event_id"])


@registered
def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.page_rows(
        fx.table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderkey"], limit=500, offset=1000
    )


@registered
def stack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name")
    )
    return relational.stack_rows(customers, suppliers)


@registered
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.distinct_rows(fx.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


# -- nested data -------------------------------------------------------------------


@registered
def widen_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "props")
    return nested.widen_records(events, "props", "k bigint")


@registered
def flatten_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("by"),
                             F.col("value")).alias("act")
    )
    return nested.flatten_records(events)


@registered
def explode_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.explode_inner(fx.record_policies(spark, sf_dir).select("id", "users"), "users", "user")


@registered
def explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.explode_outer(fx.record_policies(spark, sf_dir).select("id", "users"), "users", "user")


@registered
def explode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.explode_default(fx.record_policies(spark, sf_dir).select("id", "users"), "users", "user")


@registered
def split_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws("|", "o_orderstatus", "o_orderpriority", F.lit(""), F.col("o_custkey").cast("string"), F.lit("")).alias("text")
    )
    return joined.select("o_orderkey", F.posexplode(nested.split_pipe(F.col("text"))).alias("place", "piece"))


@registered
def build_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.array("o_orderpriority").alias("tags"),
    )
    return nested.build_json(orders)


# -- scalars -----------------------------------------------------------------------


@registered
def parse_user_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.translate(F.col("ts").cast("string"), " ", "T")
    users = fx.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.substring(text, 1, 19), F.lit("Z")).alias("createdAt"), F.concat(text, F.lit("Z")).alias("updatedAt")
    )
    return users.select(
        "event_id", parse_user_time(F.col("createdAt")).alias("createdAt"), parse_user_time(F.col("updatedAt")).alias("updatedAt")
    )


@registered
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.when(F.col("p_size") > 10, F.col("p_brand"))
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey",
        scalars.lower_text(F.col("p_type")).alias("lower"),
        scalars.joined_text(brand, F.col("p_size")).alias("joined"),
        scalars.contains_pattern(F.col("p_name"), "ring|bolt").alias("found"),
        scalars.to_text(F.col("p_size")).alias("size_text"),
        scalars.to_whole_number(F.regexp_extract("p_brand", "#(.*)", 1)).alias("brand_number"),
        scalars.to_whole_number(F.col("p_brand")).alias("no_number"),
    )


@registered
def scalar_null_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("p_size") > 10, F.col("p_size"))
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey",
        scalars.either(size > 30, F.lit("large"), F.lit("small")).alias("class"),
        scalars.is_missing(size).alias("missing"),
        scalars.part_rows(F.col("p_partkey"), F.col("p_size") * 1000, 20000.0).alias("rows"),
    )


# -- policies ----------------------------------------------------------------------


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.stored_policies(spark, sf_dir), fx.desired_policies(spark, sf_dir)


@registered
def policy_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_extract(fx.record_policies(spark, sf_dir))


@registered
def policy_wide_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_wide_current(fx.stored_policies(spark, sf_dir))


@registered
def policy_desired_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_desired_long(*_both(spark, sf_dir))


@registered
def policy_wide_desired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_wide_desired(fx.desired_policies(spark, sf_dir))


@registered
def policy_adds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_adds(*_both(spark, sf_dir))


@registered
def policy_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_deletes(*_both(spark, sf_dir))


@registered
def policy_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, desired = _both(spark, sf_dir)
    return policies.policy_updates(stored, written(desired, "desired"))


@registered
def policy_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = policies.policy_records(written(fx.desired_policies(spark, sf_dir), "desired"))
    return records.withColumn("definition", F.to_json("definition"))


@registered
def policy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, desired = _both(spark, sf_dir)
    plan = policies.policy_plan(stored, written(desired, "desired"))
    return plan.withColumn("definition", F.to_json("definition"))


@registered
def policy_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "apply")
    fx.stored_policies(spark, sf_dir).write.parquet(f"{path}/stored")
    stored = spark.read.parquet(f"{path}/stored")
    fx.desired_policies(spark, sf_dir).write.parquet(f"{path}/desired")
    desired = spark.read.parquet(f"{path}/desired")
    policies.policy_plan(stored, desired).write.parquet(f"{path}/plan")
    applied = policies.policy_apply(stored, spark.read.parquet(f"{path}/plan"))
    return policies.policy_extract(applied)


@registered
def policy_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.policy_enforce(
        fx.table(spark, sf_dir, "orders"), fx.customer_policies(spark, sf_dir), "orders", STAFF_USER
    )


# -- projects, groups, changes -------------------------------------------------------


@registered
def project_task_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = projects.project_task_rollup(
        fx.projects(spark, sf_dir), fx.project_lists(spark, sf_dir), fx.tasks(spark, sf_dir)
    )
    return rollup.select(
        "projectId", "projectName", "projectDescription", "projectCreatedBy", "projectPublic", "listId", "listName",
        "listIndex", "taskId", "taskName", "taskCreatedDate", "taskDueDate", "taskPriority", "taskOwnedBy", "taskArchived",
        F.array_size("projectMembers").alias("members"), F.array_size("taskContributors").alias("contributors"),
    )


@registered
def project_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projects.project_contributors(fx.projects(spark, sf_dir), fx.tasks(spark, sf_dir))


@registered
def membership_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("group_id"), F.col("s_suppkey").alias("user_id")
    )
    return changes.add_members(fx.memberships(spark, sf_dir), suppliers)


@registered
def membership_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    owing = fx.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_nationkey").cast("bigint").alias("group_id"), F.col("c_custkey").alias("user_id")
    )
    return changes.remove_members(fx.memberships(spark, sf_dir), owing)


@registered
def group_delete_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = fx.table(spark, sf_dir, "nation")
    regions = fx.table(spark, sf_dir, "region").where(F.col("r_name") == TRADING_REGION)
    doomed = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("group_id")
    )
    groups = nations.select(F.col("n_nationkey").cast("bigint").alias("group_id"), F.col("n_name").alias("name"))
    left_groups, left_members = changes.delete_groups(groups, fx.memberships(spark, sf_dir), doomed)
    return relational.stack_rows(left_groups, left_members)


@registered
def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = fx.tasks(spark, sf_dir).select(F.col("id").alias("group_id"), F.col("contributors").alias("users"))
    return changes.group_members(groups)


@registered
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.apply_changes(
        fx.table(spark, sf_dir, "customer"), fx.order_changes(spark, sf_dir), "c_custkey"
    )
