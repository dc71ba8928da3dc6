"""Row-policy reconcile: what must change so that stored policies match a table.

A stored policy is a record ``dataset_id, id, name, users[], filters[{column,
values[], operator, not}]``. The desired state is a long table ``dataset_id,
policy_name, policy_column, user_id, policy_value``. All datasets are handled
in one job.

A policy stands for every pair of its users and values. The comparison never
writes those pairs out: a set of desired rows equals the pairs exactly when it
has the same users, the same values, and as many distinct rows as there are
pairs. So the work grows with the lists and the desired table, not with their
product. A pass counts the desired rows of each policy: those that fit in a task meet there, and are compared
by their lists. Larger policies are compared one user or value per row, spread over all
tasks, and only distinct ones meet per policy.

One column per policy is what policies are expected to have. The changes per
column (``policy_changes`` and what is built on it) treat a policy with a stored column that is no longer
desired as deleted whole; the plan (``policy_plan``) merges all columns of a policy into one record.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tidemark.functions.names import quoted
from tidemark.functions.scalars import to_text, to_whole_number
from tidemark.operators.nested import list_or_default, split_pipe
from tidemark.operators.numbering import number_rows
from tidemark.operators.relational import (
    RESERVED_POLICY,
    RESTRICTED_PATTERN,
    filter_excluded,
    filter_present,
    join_anti,
    join_left,
    join_semi,
    mark_constant,
    ordered_distinct_concat,
    select_named,
)

POLICY = ["dataset_id", "policy_name", "policy_column"]
DESIRED = [*POLICY, "user_id", "policy_value"]
# What tells policies apart.
HEAD_KEYS = ["dataset_id", "policy_name"]

# Column names of a desired-policy dataset, and of ours.
DESIRED_NAMES = {
    "Dataset ID": "dataset_id",
    "Policy Name": "policy_name",
    "Policy Column": "policy_column",
    "User ID": "user_id",
    "Policy Value": "policy_value",
}

# Fixed types of a policy's filters and of a policy record to store.
FILTERS = "array<struct<column:string,values:array<string>,operator:string,not:boolean>>"
DEFINITION = (
    f"struct<id:bigint,type:string,name:string,filters:{FILTERS},"
    "users:array<bigint>,virtualUsers:array<string>,groups:array<string>>"
)

# A whole number as it is printed, in ASCII.
WHOLE_TEXT = re.compile("0|-?[1-9][0-9]{0,18}")

# The two kinds of items a policy is compared by.
USER, VALUE = False, True

# Up to this many values, a user's policies become literals pushed to the scan,
# when they come down to at most so many alternatives. Both forms show the same rows.
LITERAL_VALUES = 10_000
LITERAL_TERMS = 100
# Up to this many dataset names become a literal filter.
LITERAL_DATASETS = 10_000
# Desired rows that one task merges, and the buckets in which policies are counted for that.
TASK_ROWS = 500_000
POLICY_BUCKETS = 1 << 16


# -- inputs ------------------------------------------------------------------------


def desired_from_dataset(dataset: DataFrame) -> DataFrame:
    """Desired rows from a dataset with the service's five column names."""
    return select_named(dataset, list(DESIRED_NAMES)).withColumnsRenamed(DESIRED_NAMES)


def desired_rows(desired: DataFrame) -> DataFrame:
    """Desired rows as text, of rows that name a dataset."""
    return desired.where(F.col("dataset_id").isNotNull() & (F.col("dataset_id") != "")).select(
        *POLICY, to_text(F.col("user_id")).alias("user_id"), to_text(F.col("policy_value")).alias("policy_value")
    )


def current_records(records: DataFrame) -> DataFrame:
    """Stored policies that are ours to change, with a stand-in for empty lists."""
    no_filter = F.expr("array(named_struct('column', '', 'values', array('')))")
    filters = F.transform(
        "filters",
        lambda f: F.struct(f["column"].alias("column"), list_or_default(f["values"]).alias("values")),
    )
    return filter_excluded(records, "name").select(
        "dataset_id",
        F.col("id").alias("policy_id"),
        F.col("name").alias("policy_name"),
        list_or_default(F.col("users")).alias("users"),
        F.coalesce(F.when(F.size("filters") > 0, filters), no_filter).alias("filters"),
    )


def policy_extract(records: DataFrame) -> DataFrame:
    """Long form: one row per user, filter and value of each stored policy.

    This writes the pairs out and is meant for looking at policies; the
    reconcile below does not use it.
    """
    head = ["dataset_id", "policy_id", "policy_name"]
    return (
        current_records(records)
        .select(*head, "users", F.explode("filters").alias("f"))
        .select(*head, "users", F.col("f.column").alias("policy_column"), F.explode("f.values").alias("policy_value"))
        .select(*head, "policy_column", F.explode("users").alias("user_id"), "policy_value")
    )


# -- wide forms ----------------------------------------------------------------------


def policy_wide_current(records: DataFrame) -> DataFrame:
    """One row per stored policy and column, users and values joined by ``|``.

    A stored policy is one record, so this needs no grouping. Sorted by (user,
    value), all its values are first seen with its first user.
    """
    columns = current_records(records).select(
        "dataset_id", "policy_id", "policy_name", "users", "filters",
        F.explode(F.array_distinct(F.transform("filters", lambda f: f["column"]))).alias("policy_column"),
    )
    return columns.select(
        "dataset_id", "policy_id", "policy_name", "policy_column",
        _sorted_text(F.col("users")).alias("user_id"),
        _sorted_text(_values_of("filters", F.col("policy_column"))).alias("policy_value"),
    )


def _sorted_text(items: Column) -> Column:
    """Distinct items in order joined by ``|``, a missing one last as ``NA``."""
    gap = F.when(F.exists(items, F.isnull), F.array(F.lit("NA"))).otherwise(F.array())
    return F.array_join(F.concat(F.sort_array(F.array_distinct(F.array_compact(items))), gap), "|")


def _no_values() -> Column:
    return F.array().cast("array<string>")


def _values_of(filters: str, name: Column) -> Column:
    """All values that a policy's filters list for one column."""
    lists = F.filter(filters, lambda f: f["column"].eqNullSafe(name))
    return F.array_distinct(F.flatten(F.transform(lists, lambda f: F.coalesce(f["values"], _no_values()))))


def policy_wide_desired(desired: DataFrame) -> DataFrame:
    """One row per desired policy and column, users and values joined by ``|``."""
    return ordered_distinct_concat(
        desired_rows(desired), POLICY, ["user_id", "policy_value"], order=["user_id"]
    )


def current_ids(records: DataFrame) -> DataFrame:
    """Stored id of each policy name; a name with two ids in a dataset is an error."""
    ids = F.when(F.min("id") != F.max("id"), _two_ids(F.col("name"))).otherwise(F.max("id"))
    return (
        filter_excluded(records, "name")
        .groupBy("dataset_id", "name")
        .agg(ids.alias("policy_id"))
        .withColumnRenamed("name", "policy_name")
    )


def _two_ids(name: Column) -> Column:
    return F.raise_error(F.concat(F.lit("two policies are named "), name)).cast("bigint")


def policy_desired_long(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Desired rows with the stored policy's id, found by name, and a marker."""
    joined = join_left(desired_rows(desired), current_ids(records), ["dataset_id", "policy_name"])
    return mark_constant(joined, "cor")


# -- differences ---------------------------------------------------------------------


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*HEAD_KEYS), F.lit(POLICY_BUCKETS))


def _by_size(rows: DataFrame) -> list[tuple[Column, int | None]]:
    """Which policies to merge in which way: a condition on their rows, and the number of tasks to
    place them in whole, or None for policies that may outgrow a task.

    One pass counts the desired rows per bucket of policies, exactly. A bucket beyond ``TASK_ROWS`` rows may hold a
    policy of that size, so its policies are compared item by item, over all tasks.
    """
    counts = rows.groupBy(_bucket().alias("bucket")).count()
    large = F.col("count") > TASK_ROWS
    found = counts.agg(
        F.sum("count").alias("rows"), F.sort_array(F.collect_list(F.when(large, F.col("bucket")))).alias("large")
    ).first()
    tasks = (found["rows"] or 0) // max(TASK_ROWS, 1) + 1
    if not found["large"]:
        return [(F.lit(True), tasks)]
    outgrown = _bucket().isin(found["large"])
    return [(~outgrown, tasks), (outgrown, None)]


def _placed(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Rows of a policy in one task: what is grouped by policy later, also with further keys, needs no other
    shuffle. There are at least ``tasks`` of them, so that a task's memory stays the same however large the input is."""
    if tasks is None:
        return rows
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, *HEAD_KEYS)
    return rows.repartition(*HEAD_KEYS)


def _hashed(keys: list[str]) -> list[Column]:
    """Grouping keys led by their hash: aggregates of texts and lists sort, and the hash alone tells most rows apart."""
    return [F.xxhash64(*keys).alias("_hash"), *[F.col(k) for k in keys]]


def _in_scope(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Stored policies of the datasets that the desired table names.

    Up to ``LITERAL_DATASETS`` names become a filter that the scan can use to
    skip files; more of them are joined. No name at all is an error.
    """
    named = filter_present(desired, "dataset_id", required=False)
    names = [row[0] for row in named.limit(LITERAL_DATASETS + 1).collect()]
    if not names:
        raise ValueError("the desired table names no dataset")
    if len(names) <= LITERAL_DATASETS:
        return records.where(F.col("dataset_id").isin(names))
    return join_semi(records, named, ["dataset_id"])


def _current_columns(records: DataFrame) -> DataFrame:
    return current_records(records).select(
        "dataset_id", "policy_id", "policy_name",
        F.explode(F.array_distinct(F.transform("filters", lambda f: f["column"]))).alias("policy_column"),
    )


def policy_adds(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Desired policies and columns that no stored policy has. Reserved names are left alone."""
    reserved = F.col("policy_name").rlike(RESTRICTED_PATTERN) | (F.col("policy_name") == RESERVED_POLICY)
    wanted = desired_rows(desired).where(~F.coalesce(reserved, F.lit(False))).select(*POLICY).distinct()
    return join_anti(wanted, _current_columns(records), POLICY)


def policy_deletes(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Stored policies and columns that are not desired."""
    stored = _current_columns(_in_scope(records, desired)).distinct()
    return join_anti(stored, desired_rows(desired), POLICY)


def _stored_items(records: DataFrame) -> DataFrame:
    """One row per user and per value of each stored policy and column."""
    names = F.array_distinct(F.transform("filters", lambda f: f["column"]))

    def item(column: Column, part: bool, value: Column) -> Column:
        return F.struct(column.alias("policy_column"), F.lit(part).alias("part"), value.alias("item"))

    users = F.transform(names, lambda n: F.transform("users", lambda u: item(n, USER, u)))
    values = F.transform("filters", lambda f: F.transform(f["values"], lambda v: item(f["column"], VALUE, v)))
    return current_records(records).select(
        "dataset_id", "policy_name", "policy_id", F.inline(F.concat(F.flatten(users), F.flatten(values)))
    )


def _item_of_each() -> Column:
    """An item as it is, and two, user and value, of a distinct desired row. ``pairs`` counts the
    rows once; ``first`` is the user that a value is listed under."""
    def entry(part: Column, item: str, pairs: int | None, first: str | None) -> Column:
        first = F.lit(None) if first is None else F.col(first)
        return F.struct(
            part.alias("part"), F.col(item).alias("item"),
            F.lit(pairs).cast("bigint").alias("pairs"), first.cast("string").alias("first"),
        )

    row = F.array(entry(F.lit(USER), "item", 1, None), entry(F.lit(VALUE), "value", 0, "item"))
    return F.inline(F.when(F.col("part").isNull(), row).otherwise(F.array(entry(F.col("part"), "item", None, None))))


def _compare(records: DataFrame, desired: DataFrame, lists: bool) -> DataFrame:
    """Per policy and column: stored id, on which sides it is, whether the sides
    differ, and with ``lists`` the desired users and values joined by ``|``.

    A pass counts the desired rows, another compares. Policies that fit in a task are placed
    in one; of larger ones rows meet per item first, which spreads one policy over all tasks, and
    only distinct items then meet per policy.
    """
    stored, wanted = _in_scope(records, desired), desired_rows(desired)
    compared = []
    for own, tasks in _by_size(wanted):
        way = _compared_items if tasks is None else _compared_whole
        compared.append(way(stored, wanted.where(own), own, lists, tasks))
    # A policy has few columns, so its rows are few here however large it is.
    policy = Window.partitionBy(F.xxhash64(*HEAD_KEYS), *HEAD_KEYS)
    low, high = F.min("low_id").over(policy), F.max("policy_id").over(policy)
    columns = [c.select(
        *POLICY, "stored", "wanted",
        F.when(low != high, _two_ids(F.col("policy_name"))).otherwise(high).alias("policy_id"), "differs",
        F.bool_or(F.col("stored") & ~F.col("wanted")).over(policy).alias("doomed"),
        *(["user_id", "policy_value"] if lists else []),
    ) for c in compared]
    return reduce(DataFrame.unionByName, columns)


def _compared_whole(stored: DataFrame, wanted: DataFrame, own: Column, lists: bool, tasks: int) -> DataFrame:
    """Compares policies that fit in a task, each by the lists of its columns."""
    kept = current_records(stored).where(own).select(*HEAD_KEYS, "policy_id", "users", F.inline("filters")).select(
        *HEAD_KEYS, F.col("column").alias("policy_column"), "policy_id", F.struct("users", "values").alias("stored")
    )
    rows = _placed(kept.unionByName(wanted.withColumn("wanted", F.lit(True)), allowMissingColumns=True), tasks)
    # In the order in which values are listed.
    row = F.struct(F.col("user_id").isNull(), "user_id", F.col("policy_value").isNull(), "policy_value")
    columns = rows.groupBy(*_hashed(POLICY)).agg(
        F.min("policy_id").alias("low_id"), F.max("policy_id").alias("policy_id"),
        F.collect_list("stored").alias("kept"), F.sort_array(F.collect_set(F.when(F.col("wanted"), row))).alias("rows"),
    )
    sets = columns.select(
        *POLICY, "low_id", "policy_id", F.size("rows").alias("pairs"),
        F.array_distinct(F.flatten(F.transform("kept", lambda k: k["users"]))).alias("old_users"),
        F.array_distinct(F.flatten(F.transform("kept", lambda k: k["values"]))).alias("old_values"),
        F.array_distinct(F.transform("rows", lambda r: r["user_id"])).alias("users"),
        F.array_distinct(F.transform("rows", lambda r: r["policy_value"])).alias("values"),
    )
    product = F.size("old_users").cast("bigint") * F.size("old_values")
    return sets.select(
        *POLICY, (F.size("old_users") > 0).alias("stored"), (F.col("pairs") > 0).alias("wanted"), "low_id", "policy_id",
        (~_same_items("old_users", "users") | ~_same_items("old_values", "values") | (F.col("pairs") != product)).alias("differs"),
        *([F.array_join("users", "|", "NA").alias("user_id"), F.array_join("values", "|", "NA").alias("policy_value")] if lists else []),
    )


def _same_items(first: str, second: str) -> Column:
    """Two lists of distinct texts hold the same ones."""
    return F.sort_array(first).eqNullSafe(F.sort_array(second))


def _compared_items(stored: DataFrame, wanted: DataFrame, own: Column, lists: bool, tasks: None) -> DataFrame:
    """Compares policies that may outgrow a task: rows meet per item, then distinct items per policy."""
    kept = mark_constant(_stored_items(stored).where(own), "stored")
    asked = wanted.select(
        *POLICY, F.lit(None).cast("boolean").alias("part"), F.col("user_id").alias("item"), F.col("policy_value").alias("value"), F.lit(1).alias("wanted")
    )
    rows = kept.unionByName(asked, allowMissingColumns=True)
    distinct = rows.groupBy(*_hashed(["item", "value", "part", "policy_name", "dataset_id", "policy_column"])).agg(
        F.count("stored").alias("stored"), F.count("wanted").alias("wanted"),
        F.min("policy_id").alias("low_id"), F.max("policy_id").alias("policy_id"),
    )
    items = (
        distinct.select(*POLICY, "stored", "wanted", "low_id", "policy_id", _item_of_each())
        .groupBy(*_hashed(["item", "part", "policy_name", "dataset_id", "policy_column"]))
        .agg(
            F.sum("stored").alias("stored"), F.sum("wanted").alias("wanted"), F.sum("pairs").alias("pairs"),
            F.min("low_id").alias("low_id"), F.max("policy_id").alias("policy_id"),
            *([F.min("first").alias("first")] if lists else []),
        )
    )
    in_stored, in_wanted = F.col("stored") > 0, F.col("wanted") > 0
    listed = []
    if lists:
        # Placed once for both the grouping and the window that follows.
        items = items.repartition(*HEAD_KEYS)
        place = F.struct(
            F.col("first").isNull(), "first", F.col("item").isNull(), F.coalesce("item", F.lit("NA")).alias("text")
        )
        for part, name in ((USER, "user_id"), (VALUE, "policy_value")):
            some = F.collect_list(F.when((F.col("part") == part) & in_wanted, place))
            listed.append(F.array_join(F.transform(F.sort_array(some), lambda p: p["text"]), "|").alias(name))
    stored_count = [F.count_if((F.col("part") == part) & in_stored) for part in (USER, VALUE)]
    columns = items.groupBy(*_hashed(POLICY)).agg(
        F.bool_or(in_stored).alias("stored"),
        F.bool_or(in_wanted).alias("wanted"),
        F.bool_or(in_stored != in_wanted).alias("one_sided"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        (stored_count[0] * stored_count[1]).alias("product"),
        F.min("low_id").alias("low_id"),
        F.max("policy_id").alias("policy_id"),
        *listed,
    )
    return columns.select(
        *POLICY, "stored", "wanted", "low_id", "policy_id",
        (F.col("one_sided") | (F.col("pairs") != F.col("product"))).alias("differs"),
        *(["user_id", "policy_value"] if lists else []),
    )


def policy_changes(records: DataFrame, desired: DataFrame, lists: bool = False) -> DataFrame:
    """All adds, deletes and updates: action, dataset, id, name, column, and with
    ``lists`` the desired users and values joined by ``|``.

    An existing policy with a column that only the desired table has gives an
    add and an update, and one that is deleted but still has a desired column
    an update too; neither happens while policies have one column. The desired table is read three times.
    """
    stored, wanted = F.col("stored"), F.col("wanted")
    changed = ~stored | F.col("doomed") | F.col("differs")
    actions = F.array_compact(F.array(
        F.when(wanted & ~stored, F.lit("add")),
        F.when(stored & ~wanted, F.lit("delete")),
        F.when(wanted & F.col("policy_id").isNotNull() & changed, F.lit("update")),
    ))
    compared = _compare(records, desired, lists)
    items = ["user_id", "policy_value"] if lists else []
    return compared.select(F.explode(actions).alias("action"), *POLICY, "policy_id", *items).select(
        "action", "dataset_id",
        F.when(F.col("action") != "add", F.col("policy_id")).alias("policy_id"),
        "policy_name", "policy_column",
        *[F.when(F.col("action") != "delete", F.col(c)).alias(c) for c in items],
    )


def policy_updates(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Stored policies whose users and values are not the desired ones, with
    the desired users and values joined by ``|``."""
    changes = policy_changes(records, desired, lists=True)
    return changes.where(F.col("action") == "update").drop("action")


def policy_definitions(wide: DataFrame) -> DataFrame:
    """Add the policy record to store, from users and values joined by ``|``.

    A joined text can't tell a ``|`` inside a value from one between two, and has one column:
    ``policy_records`` builds records from the desired rows themselves.
    """
    filters = F.transform(split_pipe(F.col("policy_value")), lambda v: _equals(F.col("policy_column"), v))
    users = F.transform(split_pipe(F.col("user_id")), to_whole_number)
    policy_id = F.col("policy_id") if "policy_id" in wide.columns else F.lit(None)
    return wide.withColumn("definition", _record(policy_id, F.col("policy_name"), users, filters))


def _equals(column: Column, value: Column) -> Column:
    return F.struct(
        column.alias("column"), F.array(value).alias("values"), F.lit("EQUALS").alias("operator"), F.lit(False).alias("not")
    )


def _record(policy_id: Column, name: Column, users: Column, filters: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(
        policy_id.cast("bigint").alias("id"), F.lit("user").alias("type"), name.alias("name"),
        filters.alias("filters"), users.alias("users"), none.alias("virtualUsers"), none.alias("groups"),
    ).cast(DEFINITION)


# -- whole policies --------------------------------------------------------------------

# What a policy consists of, one kind per item. ``COLUMN`` is a column without values.
HEAD, COLUMN, MEMBER, ALLOWED = range(4)
ITEM = "struct<kind:int,policy_column:string,item:string,first:string>"


def _part(kind: int, column: Column | None = None, item: Column | None = None, first: Column | None = None) -> Column:
    named = {"policy_column": column, "item": item, "first": first}
    fields = [(F.lit(None) if value is None else value).cast("string").alias(name) for name, value in named.items()]
    return F.struct(F.lit(kind).alias("kind"), *fields).cast(ITEM)


def _stored_rows(records: DataFrame) -> DataFrame:
    """dataset_id, policy_name, and the rest of each stored policy that is ours."""
    own = filter_excluded(records, "name").withColumnsRenamed({"name": "policy_name", "id": "policy_id"})
    users = F.coalesce(F.col("users").cast("array<string>"), _no_values())
    filters = F.coalesce("filters", F.array().cast(records.schema["filters"].dataType))
    return own.select(*HEAD_KEYS, "policy_id", users.alias("users"), filters.alias("filters"), F.lit(1).alias("stored"))


def _wanted_rows(desired: DataFrame) -> DataFrame:
    """The desired rows that name a policy which is ours."""
    return filter_excluded(desired_rows(desired), "policy_name")


def _parts(rows: DataFrame) -> DataFrame:
    """One row per policy, and per user, value and column without values of it. Of stored policies ``odd`` tells that
    a filter is not plainly EQUALS; of desired rows ``first`` is the user a value is listed under.

    An empty desired user or column stands for none; a user that is no whole number is a missing
    one. A desired row with neither tells only that its policy is there.
    """
    parts, odd = [], F.lit(None).cast("boolean")
    if "stored" in rows.columns:
        values = F.transform("filters", lambda f: F.transform(F.coalesce(f["values"], _no_values()), lambda v: _part(ALLOWED, f["column"], v)))
        valued = F.transform(F.filter("filters", lambda f: F.size(f["values"]) > 0), lambda f: f["column"])
        bare = F.array_except(F.transform("filters", lambda f: f["column"]), valued)
        odd = _odd(rows)
        parts.append(F.when(F.col("stored").isNotNull(), F.concat(
            F.array(_part(HEAD)), F.transform(bare, lambda n: _part(COLUMN, n)),
            F.transform("users", lambda u: _part(MEMBER, item=u)), F.flatten(values),
        )))
    if "wanted" in rows.columns:
        user, column = F.col("user_id"), F.col("policy_column")
        member, named = ~user.eqNullSafe(F.lit("")), ~column.eqNullSafe(F.lit(""))
        parts.append(F.array(
            F.when(member, _part(MEMBER, item=to_whole_number(user))),
            F.when(named, _part(ALLOWED, column, F.col("policy_value"), user)),
            F.when(~member & ~named, _part(HEAD)),
        ))
    sides = [name if name in rows.columns else F.lit(None).cast(kind).alias(name)
             for name, kind in (("stored", "int"), ("wanted", "int"), ("policy_id", "bigint"))]
    return rows.select(*HEAD_KEYS, *sides, odd.alias("odd"), F.inline(F.coalesce(*parts))).where("kind IS NOT NULL")


def _merged(stored: DataFrame | None, wanted: DataFrame) -> DataFrame:
    """Stored and desired policies by name, see ``_merged_parts``. A pass counts the desired rows: policies that fit in a
    task are placed in one, larger ones are merged item by item over all tasks."""
    merged = []
    for own, tasks in _by_size(wanted):
        rows = mark_constant(wanted.where(own), "wanted")
        if stored is not None:
            rows = stored.where(own).unionByName(rows, allowMissingColumns=True)
        merged.append(_merged_parts(_parts(rows)) if tasks is None else _merged_whole(_placed(rows, tasks)))
    return reduce(DataFrame.unionByName, merged)


def _merged_whole(rows: DataFrame) -> DataFrame:
    """Merges policies that fit in a task, each from the list of its rows."""
    if "stored" not in rows.columns:
        rows = rows.withColumn("stored", F.lit(None).cast("int")).withColumn("policy_id", F.lit(None).cast("bigint"))
        rows = rows.withColumn("users", _no_values()).withColumn("filters", F.array().cast(FILTERS))
    # In the order of columns and values, so that equal values follow each other.
    row = F.struct("policy_column", F.col("policy_value").isNull().alias("missing"), F.col("policy_value").alias("item"),
                   F.col("user_id").isNull().alias("late"), F.col("user_id").alias("first"))
    policies = rows.groupBy(*_hashed(HEAD_KEYS)).agg(
        F.count("stored").alias("stored"), F.count("wanted").alias("wanted"),
        F.min("policy_id").alias("low_id"), F.max("policy_id").alias("policy_id"),
        F.collect_list(F.when(F.col("stored").isNotNull(), F.struct("users", "filters"))).alias("kept"),
        F.sort_array(F.collect_set(F.when(F.col("wanted").isNotNull(), row))).alias("rows"),
    )
    policies = policies.withColumn("old_users", F.flatten(F.transform("kept", lambda k: k["users"])))
    policies = policies.withColumn("filters", F.flatten(F.transform("kept", lambda k: k["filters"])))
    old = F.flatten(F.transform("filters", lambda f: F.transform(F.coalesce(f["values"], _no_values()), lambda v: F.struct(
        f["column"].alias("policy_column"), v.isNull().alias("missing"), v.alias("item")))))
    asked = F.array_distinct(F.transform(F.filter("rows", lambda r: ~r["first"].eqNullSafe(F.lit(""))), lambda r: r["first"]))
    listed = policies.select(
        *HEAD_KEYS, "stored", "wanted", "low_id", "policy_id", "filters",
        F.array_distinct("old_users").alias("old_users"), F.sort_array(old).alias("old"),
        F.array_distinct(F.transform(asked, lambda u: to_text(to_whole_number(u)))).alias("asked"),
        F.filter("rows", lambda r: ~r["policy_column"].eqNullSafe(F.lit(""))).alias("rows"),
    ).withColumn("old", _each_once("old")).withColumn("rows", _each_once("rows"))
    bare = F.array_except(F.transform("filters", lambda f: f["column"]), F.transform("old", lambda v: v["policy_column"]))
    new = F.transform("rows", lambda r: F.struct(r["policy_column"].alias("policy_column"), r["missing"].alias("missing"), r["item"].alias("item")))
    value = lambda r: F.struct(*[r[f].alias(f) for f in ("policy_column", "late", "first", "missing", "item")])
    # Only what is on both sides needs to be compared.
    both = (F.col("stored") > 0) & (F.col("wanted") > 0)
    differs = ~_same_items("old_users", "asked") | ~F.col("old").eqNullSafe(new) | (F.size(bare) > 0) | _odd(rows)
    return listed.select(
        *HEAD_KEYS, (F.col("stored") > 0).alias("stored"), (F.col("wanted") > 0).alias("wanted"),
        F.when(both, differs).otherwise(True).alias("differs"),
        F.when(F.col("low_id") != F.col("policy_id"), _two_ids(F.col("policy_name"))).otherwise(F.col("policy_id")).alias("policy_id"),
        F.sort_array(F.transform(F.array_distinct(F.transform("filters", lambda f: f["column"])), lambda n: F.struct(n.alias("policy_column")))).alias("stored_columns"),
        F.sort_array(F.transform("asked", lambda u: F.struct(u.isNull().alias("missing"), u.alias("item")))).alias("users"),
        F.sort_array(F.transform("rows", value)).alias("values"),
    )


def _each_once(name: str) -> Column:
    """Of a list sorted by column and value, the first entry of each."""
    def repeats(entry: Column, place: Column) -> Column:
        before = F.get(F.col(name), place - 1)
        return (place > 0) & before["policy_column"].eqNullSafe(entry["policy_column"]) & before["item"].eqNullSafe(entry["item"])

    return F.filter(name, lambda entry, place: ~repeats(entry, place))


def _odd(rows: DataFrame) -> Column:
    """A filter is not plainly EQUALS."""
    known = rows.schema["filters"].dataType.elementType.fieldNames()
    return F.exists("filters", lambda f: F.lit(False) if "operator" not in known else
                    ~f["not"].eqNullSafe(F.lit(False)) | ~f["operator"].eqNullSafe(F.lit("EQUALS")))


def _merged_parts(parts: DataFrame) -> DataFrame:
    """Per policy: on which sides it is, whether they differ, its columns on each side, and the desired users and values in order.

    Equal parts meet first, which spreads a large policy over all tasks; only distinct ones then meet per policy.
    """
    items = parts.groupBy(*_hashed(["item", "kind", "policy_name", "dataset_id", "policy_column"])).agg(
        F.count("stored").alias("stored"), F.count("wanted").alias("wanted"), F.min("first").alias("first"),
        F.bool_or("odd").alias("odd"), F.min("policy_id").alias("low_id"), F.max("policy_id").alias("policy_id"),
    )
    stored, wanted, kind = F.col("stored") > 0, F.col("wanted") > 0, F.col("kind")
    text = F.struct(F.col("item").isNull().alias("missing"), "item")
    value = F.struct("policy_column", F.col("first").isNull().alias("late"), "first", F.col("item").isNull().alias("missing"), "item")

    def listed(of: int, entry: Column) -> Column:
        return F.sort_array(F.collect_list(F.when((kind == of) & wanted, entry)))

    column = F.when(stored & kind.isin(COLUMN, ALLOWED), F.struct("policy_column"))
    # Items of large policies come from all over, so nothing could be combined on the way.
    return items.repartition(*HEAD_KEYS).groupBy(*_hashed(HEAD_KEYS)).agg(
        F.bool_or(stored).alias("stored"), F.bool_or(wanted).alias("wanted"),
        (F.coalesce(F.bool_or(F.when(kind != HEAD, stored != wanted)), F.lit(False))
         | F.coalesce(F.bool_or("odd"), F.lit(False))).alias("differs"),
        F.when(F.min("low_id") != F.max("policy_id"), _two_ids(F.col("policy_name"))).otherwise(F.max("policy_id")).alias("policy_id"),
        F.sort_array(F.collect_set(column)).alias("stored_columns"),
        listed(MEMBER, text).alias("users"), listed(ALLOWED, value).alias("values"),
    ).drop("_hash")


def _rows_of(merged: DataFrame, action: Column) -> DataFrame:
    """A row per column of each policy whose ``action`` is not null: its texts, and the record of the whole policy."""
    gone = F.col("action") == "delete"
    # Values are in order of their columns.
    wanted_columns = F.array_distinct(F.transform("values", lambda v: v["policy_column"]))
    names = F.when(gone, F.transform("stored_columns", lambda c: c["policy_column"])).otherwise(wanted_columns)
    users = F.transform("users", lambda u: u["item"])
    filters = F.transform("values", lambda v: _equals(v["policy_column"], v["item"]))
    definition = _record(F.col("policy_id"), F.col("policy_name"), F.transform(users, to_whole_number), filters)
    kept = ["action", "dataset_id", "policy_id", "policy_name", "users", "values", "definition"]
    changed = merged.withColumn("action", action).withColumn("definition", F.when(F.col("action").isNotNull(), definition))
    # No list gives no row. A filter on the action would move below the comparison, write it out as one expression,
    # and so compare every policy twice, its lists made anew for each of their entries.
    listed = F.when(F.col("action").isNotNull(), F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(""))))
    each = changed.select(*kept, F.explode(listed).alias("policy_column"))
    own = F.filter("values", lambda v: v["policy_column"].eqNullSafe(F.col("policy_column")))
    return each.select(
        "action", "dataset_id", "policy_id", "policy_name", "policy_column",
        F.when(~gone, F.array_join(F.transform("users", lambda u: u["item"]), "|", "NA")).alias("user_id"),
        F.when(~gone, F.array_join(F.transform(own, lambda v: v["item"]), "|", "NA")).alias("policy_value"),
        F.when(~gone, F.col("definition")).alias("definition"),
    )


def policy_records(desired: DataFrame) -> DataFrame:
    """dataset_id, policy_name, policy_column, definition: the record of each desired policy, on a row per column of it.

    A record holds the policy's users and a filter per value of every column, so it stands for
    their product. The desired rows are read twice: pass a written table, not a costly plan.
    """
    return _rows_of(_merged(None, _wanted_rows(desired)), F.lit("add")).select(*POLICY, "definition")


def policy_plan(records: DataFrame, desired: DataFrame) -> DataFrame:
    """Every change to make: action, dataset, id, name, column, and for adds and
    updates the policy's users and the column's values joined by ``|`` and the record to store.

    A policy is added, deleted or updated whole: each of its columns is a row, and all have the
    one record of the policy. It is updated when its users, its columns, a column's values or a filter's kind are
    not the desired ones. Desired rows that list different users or values in turn come down to
    the product that a record stands for, so an applied plan leaves nothing to do. Reserved names and rows that
    name no policy are left alone. A desired table that names no dataset at all is an error. It is read three times: for its
    datasets, for the sizes of its policies, and for the plan.
    """
    merged = _merged(_stored_rows(_in_scope(records, desired)), _wanted_rows(desired))
    action = (
        F.when(~F.col("stored"), F.lit("add")).when(~F.col("wanted"), F.lit("delete")).when(F.col("differs"), F.lit("update"))
    )
    return _rows_of(merged, action)


# -- apply and enforce ---------------------------------------------------------------


def policy_apply(records: DataFrame, plan: DataFrame) -> DataFrame:
    """Stored policies after the plan. New policies are numbered on from the
    greatest id of all. Untouched policies stay as they are, with whatever else is kept of them; a changed
    one has only what its record holds, no virtual users and groups.

    All rows of a policy have one record. The plan is read several times: pass a written table, not a costly plan.
    """
    doomed = plan.where(F.col("action") == "delete").select("dataset_id", F.col("policy_id").alias("id"))
    record = F.any_value("definition").alias("definition")
    updates = plan.where(F.col("action") == "update").groupBy("dataset_id", F.col("policy_id").alias("id")).agg(record)
    gone = doomed.unionByName(updates.select("dataset_id", "id"))
    kept = join_anti(records, gone, ["dataset_id", "id"])

    name = ["dataset_id", "policy_name"]
    adds = plan.where(F.col("action") == "add").groupBy(*name).agg(record)
    top = records.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    numbered = number_rows(adds, [], name, number="_number", size="_size").crossJoin(F.broadcast(top))
    added = numbered.select("dataset_id", (F.col("_number") + F.col("top")).alias("id"), "definition")
    known = [f for f in ("type", "name", "filters", "users", "virtualUsers", "groups") if f in records.columns]
    written = updates.unionByName(added).select(
        "dataset_id", "id", *[F.col(f"definition.{f}").cast(records.schema[f].dataType.simpleString()).alias(f) for f in known]
    )
    return kept.unionByName(written, allowMissingColumns=True)


def policies_of(records: DataFrame, dataset_id: str, user: object, memberships: DataFrame | None = None) -> DataFrame:
    """Filters of the stored policies that hold for a user, one row per policy.

    A policy names users, virtual users, or groups; ``memberships`` (group_id,
    user_id) tells the user's groups.
    """
    filters = F.coalesce(F.col("filters"), F.array().cast(records.schema["filters"].dataType)).alias("filters")
    here = records.where(F.col("dataset_id") == dataset_id)
    named = F.lit(False)
    for column in ("users", "virtualUsers"):
        if column in records.columns:
            named = named | F.coalesce(F.array_contains(F.col(column).cast("array<string>"), str(user)), F.lit(False))
    mine = here.where(named).select(filters)
    if memberships is None or "groups" not in records.columns:
        return mine
    own = memberships.where(F.col("user_id").cast("string") == str(user)).select(F.col("group_id").cast("string").alias("_group"))
    grouped = here.where(~named).select(filters, F.explode(F.array_distinct(F.col("groups").cast("array<string>"))).alias("_group"))
    return mine.unionByName(grouped.join(own, "_group", "left_semi").select("filters"))


def policy_enforce(
    df: DataFrame, records: DataFrame, dataset_id: str, user: object, enabled: bool = True,
    literal_values: int = LITERAL_VALUES, memberships: DataFrame | None = None,
) -> DataFrame:
    """Rows of a dataset that a user may see under its stored policies.

    Values of one column are alternatives, columns of one policy must all
    match, and policies are alternatives. Without a policy the user sees
    nothing; a policy without filters, or ``enabled=False``, shows everything.
    A filter without values matches no row. Filters that are not plainly
    ``EQUALS``, a missing operator or ``not`` among them, are refused.

    Few values become literals that reach the scan as pushed filters. Beyond
    ``literal_values`` the policies are one table of signatures, each led by the column of its
    set with the most values, and one join of the dataset with that table tests all sets of
    columns.
    """
    if not enabled:
        return df
    mine = policies_of(records, dataset_id, user, memberships)
    odd = F.exists("filters", lambda f: ~f["not"].eqNullSafe(F.lit(False)) | ~f["operator"].eqNullSafe(F.lit("EQUALS")))
    names = F.sort_array(F.array_distinct(F.transform("filters", lambda f: f["column"])))
    listed = F.aggregate("filters", F.lit(0).cast("bigint"), lambda n, f: n + F.size(F.coalesce(f["values"], _no_values())))
    # One row per set of columns: as many as the policies' authors use, not as there are policies.
    shapes = mine.groupBy(names.alias("names")).agg(
        F.sum(listed).alias("n"), F.max(odd).alias("odd"), F.count(F.lit(1)).alias("policies")
    ).collect()
    if any(s["odd"] for s in shapes):
        raise ValueError("only EQUALS filters can be enforced")
    if not shapes:
        return df.where(F.lit(False))
    if any(not s["names"] for s in shapes):
        return df
    unknown = {n for s in shapes for n in s["names"]} - set(df.columns)
    if unknown:
        raise ValueError(f"policies name unknown columns: {sorted(unknown, key=repr)}")

    if sum(s["n"] + s["policies"] for s in shapes) <= literal_values:
        terms = _merged_terms(mine.collect())
        if len(terms) <= LITERAL_TERMS:
            conditions = [
                reduce(Column.__and__, [_is_one_of(df, n, sorted(v)) for n, v in term.items()]) for term in terms
            ]
            return df.where(reduce(Column.__or__, conditions))

    values = mine.select(names.alias("names"), F.inline("filters")).select("names", "column", F.explode("values").alias("value"))
    spread = {
        (tuple(r["names"]), r["column"]): r["n"]
        for r in values.groupBy("names", "column").agg(F.approx_count_distinct("value").alias("n")).collect()
    }
    leads = {}
    for shape in shapes:
        columns = tuple(shape["names"])
        leads[columns] = min(columns, key=lambda n: (-spread.get((columns, n), 0), n))
    tested = sorted({n for columns in leads for n in columns})
    return _probed(df, _signatures(mine, names, leads), sorted(set(leads.values())), tested)


def _signatures(mine: DataFrame, names: Column, leads: dict[tuple[str, ...], str]) -> DataFrame:
    """_lead, _value, _others: a row per value of each policy's leading column, and what the policy asks of its
    other columns. All sets of columns share the one table."""
    lead = F.coalesce(*[F.when(names == F.array(*[F.lit(n) for n in columns]), F.lit(first)) for columns, first in leads.items()])
    others = F.transform(
        F.filter(names, lambda n: n != lead), lambda n: F.struct(n, F.sort_array(_values_of("filters", n)))
    ).cast("array<struct<column:string,values:array<string>>>")
    return mine.select(lead.alias("_lead"), F.explode(_values_of("filters", lead)).alias("_value"), others.alias("_others")).distinct()


def _probed(df: DataFrame, signatures: DataFrame, leads: list[str], tested: list[str]) -> DataFrame:
    """The rows of ``df`` that a signature lets through, by one semi join.

    A row asks for each leading column's own value; a value that a third of the rows hold is
    split like any skewed side. With several leading columns a row that passes more than
    once is one again at the end.
    """
    names = [f"_own_{i}" for i in range(len(df.columns))]
    own = dict(zip(df.columns, names))
    rows = df.toDF(*names)
    asked = signatures.select(F.col("_lead").alias("_lead_of"), F.col("_value").alias("_value_of"), "_others")
    probes = [F.struct(F.lit(n).alias("_lead"), F.col(own[n]).cast("string").alias("_value")) for n in leads]
    if len(probes) > 1:
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
    probing = rows.select("*", F.explode(F.array(*probes)).alias("_probe")).where("_probe._value IS NOT NULL")
    shown = F.create_map(*[x for n in tested for x in (F.lit(n), F.col(own[n]).cast("string"))])
    met = (F.col("_probe._lead") == F.col("_lead_of")) & (F.col("_probe._value") == F.col("_value_of")) & F.forall(
        "_others", lambda o: F.coalesce(F.array_contains(o["values"], F.element_at(shown, o["column"])), F.lit(False))
    )
    passed = probing.join(asked, met, "left_semi").drop("_probe")
    if len(probes) > 1:
        passed = passed.dropDuplicates(["_row"])
    return passed.select(*names).toDF(*df.columns)


def _merged_terms(policies: list[Row]) -> list[dict[str, frozenset[str]]]:
    """Per policy the allowed values of each column; policies that differ in one
    column only become one, with the values of both."""
    terms = []
    for policy in policies:
        term: dict[str, frozenset[str]] = {}
        for f in policy["filters"]:
            term[f["column"]] = term.get(f["column"], frozenset()) | {v for v in f["values"] or () if v is not None}
        terms.append(term)
    for column in sorted({name for term in terms for name in term}):
        merged: dict[frozenset, dict[str, frozenset[str]]] = {}
        for term in terms:
            others = frozenset((n, v) for n, v in term.items() if n != column)
            key = others | {(column, column in term)}
            if key in merged and column in term:
                term = merged[key] | {column: merged[key][column] | term[column]}
            merged[key] = term
        terms = list(merged.values())
    return terms


def _is_one_of(df: DataFrame, name: str, values: list[str]) -> Column:
    """The column's text is among ``values``, written so that a scan can use it.

    Whole-number and text columns are compared as what they are; other types
    by the text they print as.
    """
    kind = df.schema[name].dataType.typeName()
    col = F.col(quoted(name))
    if kind in ("byte", "short", "integer", "long"):
        # Only what a 64-bit number prints as can equal one.
        whole = [int(v) for v in values if WHOLE_TEXT.fullmatch(v) and -(1 << 63) <= int(v) < 1 << 63]
        return col.isin(whole)
    return (col if kind == "string" else col.cast("string")).isin(values)
