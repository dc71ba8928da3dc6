"""Inputs of the registered queries, derived from the given tables.

Every input grows with the tables it comes from, and each policy, project or
task belongs to one order or customer, so none outgrows its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lines of orders that one task sorts or groups.
TASK_LINES = 500_000


def _lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and supplier of each line. Of more lines than a task should sort, those of an order are placed in one of as
    many tasks as that takes: left to itself, a join by order merges them into few tasks however many lines there are."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    tasks = lines.count() // TASK_LINES + 1
    if tasks == 1:
        return lines
    return lines.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "l_orderkey")


def _order_name() -> Column:
    return F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))


def stored_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per finished or partly shipped order: its suppliers see the
    order's year and the next, or only its year when the customer owes money."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'")
    users = _lines_by_order(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("users"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    year = F.year("o_orderdate")
    name = (
        F.when(F.col("o_totalprice") > 480000, F.concat(F.lit("AA - Restricted "), F.col("o_orderkey").cast("string")))
        .when(F.col("o_totalprice") < 20000, F.lit("All Rows"))
        .otherwise(_order_name())
    )
    values = F.when(F.col("c_acctbal") < 0, F.array(year)).otherwise(F.array(year, year + 1)).cast("array<string>")
    return (
        orders.join(users, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderpriority").alias("dataset_id"), F.col("o_orderkey").alias("id"), name.alias("name"), "users",
            F.array(F.struct(
                F.lit("order_year").alias("column"), values.alias("values"),
                F.lit("EQUALS").alias("operator"), F.lit(False).alias("not"),
            )).alias("filters"),
        )
    )


def record_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per order with two columns; partly shipped orders have no users,
    open orders no filters."""
    filters = F.array(
        F.struct(F.lit("year").alias("column"), F.array(F.year("o_orderdate"), F.year("o_orderdate") + 1).cast("array<string>").alias("values"),
                 F.lit("EQUALS").alias("operator"), F.lit(False).alias("not")),
        F.struct(F.lit("priority").alias("column"), F.array("o_orderpriority").alias("values"),
                 F.lit("EQUALS").alias("operator"), F.lit(False).alias("not")),
    )
    name = F.when(F.col("o_totalprice") > 480000, F.concat(F.lit("AA - Restricted "), F.col("o_orderkey").cast("string"))).when(
        F.col("o_totalprice") < 20000, F.lit("All Rows")
    ).otherwise(_order_name())
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset_id"), F.col("o_orderkey").alias("id"), name.alias("name"),
        F.when(F.col("o_orderstatus") == "P", F.array().cast("array<bigint>")).otherwise(F.array("o_custkey", F.month("o_orderdate").cast("bigint"))).alias("users"),
        F.when(F.col("o_orderstatus") == "O", F.slice(filters, 1, 0)).otherwise(filters).alias("filters"),
    )


def desired_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per finished or open order: its suppliers who do not owe money
    see the order's year and the next."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    lines = _lines_by_order(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select("s_suppkey")
    year = F.year("o_orderdate")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_orderpriority").alias("dataset_id"), _order_name().alias("policy_name"),
            F.lit("order_year").alias("policy_column"), F.col("l_suppkey").cast("string").alias("user_id"),
            F.explode(F.array(year, year + 1).cast("array<string>")).alias("policy_value"),
        )
    )


def wished_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per order: each of its suppliers sees the order's year, who owes money no year."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_orderpriority").alias("dataset_id"), _order_name().alias("policy_name"),
            F.lit("order_year").alias("policy_column"), F.col("l_suppkey").cast("string").alias("user_id"),
            F.when(F.col("s_acctbal") >= 0, F.year("o_orderdate").cast("string")).otherwise("none").alias("policy_value"),
        )
    )


def customer_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What staff of a nation may see of the orders: finished orders of its
    customers, and every order of those in the building trade."""
    own = F.struct(F.lit("o_custkey").alias("column"), F.array(F.col("c_custkey").cast("string")).alias("values"),
                   F.lit("EQUALS").alias("operator"), F.lit(False).alias("not"))
    finished = F.struct(F.lit("o_orderstatus").alias("column"), F.array(F.lit("F")).alias("values"),
                        F.lit("EQUALS").alias("operator"), F.lit(False).alias("not"))
    return table(spark, sf_dir, "customer").select(
        F.lit("orders").alias("dataset_id"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.array(F.col("c_nationkey").cast("bigint")).alias("users"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.array(own)).otherwise(F.array(own, finished)).alias("filters"),
    )


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A project per customer; members supplied its orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    members = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.collect_set("l_suppkey").alias("members"))
    )
    return table(spark, sf_dir, "customer").join(members, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"),
        "members", F.col("c_nationkey").alias("createdBy"),
        F.lit(None).cast("timestamp_ntz").alias("createdDate"),
        (F.col("c_acctbal") >= 0).alias("public"), F.lit(None).cast("timestamp_ntz").alias("dueDate"),
    )


def _list_id() -> Column:
    return F.col("o_custkey") * 10 + F.substring("o_orderpriority", 1, 1).cast("int")


def project_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list per customer and priority of its orders."""
    return table(spark, sf_dir, "orders").select(
        _list_id().alias("id"), F.col("o_orderpriority").alias("name"), F.lit("TODO").alias("type"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("index"), F.col("o_custkey").alias("projectId"),
    ).distinct()


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task per order; its suppliers contribute."""
    contributors = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("contributors"))
    return table(spark, sf_dir, "orders").join(
        contributors, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("projectId"), _list_id().alias("projectListId"),
        F.concat(F.lit("task"), F.col("o_orderkey").cast("string")).alias("taskName"),
        F.lit(None).cast("string").alias("description"), F.col("o_orderdate").alias("createdDate"),
        F.date_add("o_orderdate", 30).alias("dueDate"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.lit(0).alias("createdBy"), F.col("o_orderstatus").alias("ownedBy"), "contributors",
        F.lit(0).alias("attachmentCount"), F.array("o_orderstatus").alias("tags"),
        (F.col("o_orderstatus") == "F").alias("archived"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("userName"),
        F.col("user_id").alias("userId"), F.lit("USER").alias("userType"), F.col("event_type").alias("actionType"),
        F.concat(F.lit("object"), F.col("event_id").cast("string")).alias("objectName"), F.col("event_id").alias("objectId"),
        F.lit("DATASET").alias("objectType"), F.col("props").alias("eventText"), F.col("value"),
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a member of its nation's group."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("group_id"), F.col("c_custkey").alias("user_id")
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to customers: finished orders set the balance, partly shipped
    ones the segment, cheap open ones delete, dear open ones create anew.
    Suppliers become new customers, but those who owe money are only updates."""
    change = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 50000), "delete")
        .when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000), "create")
        .otherwise("update").alias("op"),
        F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("int").alias("c_nationkey"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("c_acctbal"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("c_mktsegment"),
    )
    new = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_suppkey").alias("seq"),
        F.when(F.col("s_acctbal") < 0, "update").otherwise("create").alias("op"),
        F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"),
    )
    return change.unionByName(new)


def write_json_pages(df: DataFrame, path: str, page_size: int) -> None:
    """Land a table as a paged listing: a line per page, an array of records each."""
    place = F.monotonically_increasing_id()
    paged = df.select(
        F.struct(*df.columns).alias("record"),
        F.shiftright(place, 33).alias("task"),
        F.floor(F.expr("monotonically_increasing_id() & 8589934591") / page_size).alias("page"),
    )
    pages = paged.groupBy("task", "page").agg(F.to_json(F.collect_list("record")).alias("value"))
    pages.select("value").write.text(path)
