"""Projections, filters, joins, aggregates, sorting and stacking.

Joins take explicit keys and treat two missing keys as equal. They are written
so that no single key can fill a task: the side that may repeat a key is kept
on the side adaptive execution can split, or reduced to distinct keys first.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import exactly, quoted
from tidemark.functions.scalars import is_present_text
from tidemark.operators.numbering import in_order, page_of, with_ties

# Policy names the service or its owners reserve.
RESERVED_POLICY = "All Rows"
RESTRICTED_PATTERN = "AA - Restricted"

# Columns of an audit listing, in order.
ACTIVITY_COLUMNS = [
    "time", "userName", "userId", "userType", "actionType",
    "objectName", "objectId", "objectType", "eventText",
]


# -- projections and filters ---------------------------------------------------


def select_named(df: DataFrame, names: list[str]) -> DataFrame:
    """Pick columns by exact name; spaces, dots and backticks are fine."""
    return df.select(*exactly(names))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def mark_constant(df: DataFrame, name: str, value: object = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def filter_present(df: DataFrame, key: str, required: bool = True) -> DataFrame:
    """Distinct values of ``key`` that are neither missing nor empty.

    With ``required``, no such value is an error.
    """
    found = df.where(is_present_text(F.col(key))).select(key)
    if required and found.isEmpty():
        raise ValueError(f"no value found in {key!r}")
    return found.distinct()


def filter_excluded(
    df: DataFrame, name: str, pattern: str = RESTRICTED_PATTERN, reserved: str = RESERVED_POLICY
) -> DataFrame:
    """Drop rows whose name matches ``pattern``, equals ``reserved`` or is missing."""
    return df.where(~F.col(name).rlike(pattern) & (F.col(name) != reserved))


def lookup_by_key(df: DataFrame, key: str, value: object) -> DataFrame:
    """Rows with ``key`` equal to ``value``; none is an error."""
    found = df.where(F.col(key) == F.lit(value))
    if found.isEmpty():
        raise LookupError(f"no row with {key} = {value!r}")
    return found


EPOCH = datetime(1970, 1, 1)


def _moment(bound: str | int | date) -> datetime:
    """A bound as UTC clock time: a date, a time with or without zone, their
    ISO text, or milliseconds since 1970."""
    if isinstance(bound, str):
        bound = int(bound) if bound.lstrip("-").isdecimal() else datetime.fromisoformat(bound)
    if isinstance(bound, int) and not isinstance(bound, bool):
        return EPOCH + timedelta(milliseconds=bound)
    if isinstance(bound, datetime):
        return bound.astimezone(timezone.utc).replace(tzinfo=None) if bound.tzinfo else bound
    if isinstance(bound, date):
        return datetime(bound.year, bound.month, bound.day)
    raise TypeError(f"no time: {bound!r}")


def activity_window(
    df: DataFrame,
    start: str | int | date | None = None,
    end: str | int | date | None = None,
    limit: int = 0,
    offset: int = 0,
) -> DataFrame:
    """Audit rows from ``start`` to ``end``, both included, in nine columns.

    A missing bound is open. With a limit or offset the rows are paged by time.
    Where the time is a number it is milliseconds since 1970.
    """
    kind = df.schema["time"].dataType
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            moment = _moment(bound)
            if isinstance(kind, T.IntegralType):
                step = timedelta(milliseconds=1)
                value = F.lit(-((EPOCH - moment) // step) if keep is Column.__ge__ else (moment - EPOCH) // step)
            else:
                value = F.lit(str(moment)).cast(kind)
            df = df.where(keep(F.col("time"), value))
    rows = df.select(*ACTIVITY_COLUMNS)
    if limit or offset:
        return page_rows(rows, ACTIVITY_COLUMNS, limit, offset)
    return rows


# -- joins ---------------------------------------------------------------------


def _same(keys: list[str]) -> tuple[dict[str, str], Column]:
    renamed = {k: f"_right_{k}" for k in keys}
    matches = [F.col(quoted(k)).eqNullSafe(F.col(quoted(r))) for k, r in renamed.items()]
    return renamed, reduce(Column.__and__, matches)


def _check_columns(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    shared = {c for c in left.columns if c in right.columns and c not in keys}
    if shared:
        raise ValueError(f"columns on both sides but not keys: {sorted(shared)}")


def _inner(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    renamed, condition = _same(keys)
    joined = left.join(right.withColumnsRenamed(renamed), condition, how)
    return joined.drop(*renamed.values())


def join_left(left: DataFrame, right: DataFrame, keys: list[str], many: bool = False) -> DataFrame:
    """Left join on ``keys``; missing keys match each other.

    A hot key on the left is split by adaptive execution as it is. Set ``many``
    when the right side may hold very many rows of one key: an outer join
    cannot split that side, so matched rows come from an inner join, which can,
    and unmatched rows from an anti join to the distinct right keys.
    """
    _check_columns(left, right, keys)
    if not many:
        return _inner(left, right, keys, "left")
    matched = _inner(left, right, keys)
    alone = join_anti(left, right, keys)
    return matched.unionByName(alone, allowMissingColumns=True)


def join_full(many: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Full join on ``keys``; missing keys match each other.

    A full join cannot be split on either side, so it is put together from two
    that can. The first side may repeat a key without bound.
    """
    _check_columns(many, few, keys)
    matched = _inner(many, few, keys, "left")
    alone = join_anti(few, many, keys)
    return matched.unionByName(alone, allowMissingColumns=True)


def join_anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a partner; the right side shrinks to its keys first."""
    renamed, condition = _same(keys)
    distinct_keys = right.select(*exactly(keys)).distinct().withColumnsRenamed(renamed)
    return left.join(distinct_keys, condition, "left_anti")


def join_semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` with a partner; the right side shrinks to its keys first."""
    renamed, condition = _same(keys)
    distinct_keys = right.select(*exactly(keys)).distinct().withColumnsRenamed(renamed)
    return left.join(distinct_keys, condition, "left_semi")


def pair_lists(df: DataFrame, first: str, second: str, names: tuple[str, str]) -> DataFrame:
    """Every pair of the elements of two lists in the same record.

    Two generators over one row: nothing is shuffled or joined.
    """
    kept = [c for c in df.columns if c not in (first, second)]
    return (
        df.select(*kept, second, F.explode(first).alias(names[0]))
        .select(*kept, names[0], F.explode(second).alias(names[1]))
    )


# -- aggregates ----------------------------------------------------------------


def ordered_distinct_concat(
    df: DataFrame, keys: list[str], columns: list[str], order: list[str], sep: str = "|"
) -> DataFrame:
    """Per group and column, distinct values in first-seen order joined by ``sep``.

    Rows are first cut down to distinct values with the place each was first
    seen, spread over all values, so only what is printed meets in one group.
    A missing value prints as ``NA``.
    """
    if len(order) == 1:
        place = F.col(order[0])
    else:
        place = F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])
    cells = [
        # Values of the leading order column are in order by themselves.
        F.struct(
            F.lit(i).cast("byte").alias("_i"),
            F.col(c).cast("string").alias("_v"),
            (F.when(F.lit(False), place) if c == order[0] else place).alias("_place"),
        )
        for i, c in enumerate(columns)
    ]
    firsts = (
        df.select(*keys, F.inline(F.array(*cells))).groupBy(*keys, "_i", "_v").agg(F.min("_place").alias("_place"))
    )
    shown = F.struct(
        F.col("_place").isNull(), "_place", F.col("_v").isNull(), F.coalesce("_v", F.lit("NA")).alias("_v")
    )
    lists = [
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("_i") == i, shown))), lambda s: s["_v"]), sep).alias(c)
        for i, c in enumerate(columns)
    ]
    return firsts.groupBy(*keys).agg(*lists)


def group_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def repeat_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of groups, greatest group, rows beyond each group's first."""
    return group_counts(df, keys).agg(
        F.count(F.lit(1)).alias("groups"),
        F.max("n").alias("greatest"),
        F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("repeats"),
    )


# -- sorting, paging, stacking ---------------------------------------------------


def sort_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Ascending, missing values last. End ``order`` with a unique column, so
    that equal leading values still spread over many range partitions."""
    return df.orderBy(*in_order(order))


def page_rows(df: DataFrame, order: list[str], limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in ascending order; limit 0 is no limit.

    Rows that are alike in ``order`` follow each other by their other columns, so that pages
    neither repeat nor miss one.
    """
    if not limit and not offset:
        return sort_rows(df, with_ties(df, order))
    return page_of(df, order, offset, limit or None)


def stack_rows(*frames: DataFrame) -> DataFrame:
    """Tables below each other, columns by name, absent ones null.

    Columns of one name must agree on type, up to number width.
    """
    kinds: dict[str, str] = {}
    for frame in frames:
        for field in frame.schema.fields:
            simple = field.dataType.typeName()
            simple = "number" if simple in ("byte", "short", "integer", "long", "float", "double", "decimal") else simple
            if simple != "void" and kinds.setdefault(field.name, simple) != simple:
                raise TypeError(f"column {field.name!r} is both {kinds[field.name]} and {simple}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
