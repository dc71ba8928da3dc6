"""Row numbers inside groups of any size, and pages of a sorted table.

Rows are put in order once: range partitions of keys and order, each sorted and
written with its number and every row's place in it. A group is then a stretch of one
partition or of some neighbours, and the rows it has in the partitions before are a
prefix sum of one count per partition and key. A row's number is that sum and its
place, so the work per row is the same for a group in one partition or in thousands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from tidemark.functions.names import exactly, quoted
from tidemark.session import written

# Rows that are sampled to find where a page begins and ends.
SAMPLE = 4096
# A page is cut out of a band of rows that has this many more than the page at most, or as
# few as rows of equal order allow.
BAND_ROWS = 200_000


def in_order(columns: list[str]) -> list[Column]:
    """Ascending, missing values last."""
    return [F.col(quoted(c)).asc_nulls_last() for c in columns]


def order_value(order: list[str]) -> Column:
    """One comparable value per row, missing values last."""
    return F.struct(*[f for c in order for f in (F.col(quoted(c)).isNull(), F.col(quoted(c)))])


def placed_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows written in range partitions of ``columns``: _part ascends with them, and _row inside a
    partition. Rows that are alike in ``columns`` are spread too, by where they come from."""
    by = [*in_order(columns), F.col("_copy")]
    salted = df.withColumn("_copy", F.monotonically_increasing_id())
    placed = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_copy")
    return written(
        placed.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "placed"
    )


def number_rows(df: DataFrame, keys: list[str], order: list[str], number: str = "rn", size: str = "n") -> DataFrame:
    """Add each row's number in its group (by ``order``) and the group's size.

    ``order`` should be unique in a group; rows that are alike in it are numbered in any order.
    Without ``keys`` the whole table is one group. The rows are written once, in order.
    """
    placed = placed_rows(df, [*keys, *order])
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    stretches = placed.groupBy("_part", *[F.col(quoted(k)).alias(n) for k, n in names.items()]).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_own")
    )
    group = Window.partitionBy(*names.values())
    before = F.sum("_own").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stretches.select(
        F.col("_part").alias("_in"), *names.values(), F.sum("_own").over(group).alias(size),
        (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_in")
    for key, name in names.items():
        same = same & F.col(quoted(key)).eqNullSafe(F.col(name))
    numbered = placed.join(starts, same).withColumn(number, F.col("_row") + F.col("_shift"))
    return numbered.select(*exactly(df.columns), number, size)


# -- pages -------------------------------------------------------------------------


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def with_ties(df: DataFrame, order: list[str]) -> list[str]:
    """``order`` and then the other columns that can be put in order."""
    return [*order, *[f.name for f in df.schema.fields if f.name not in order and _orderable(f.dataType)]]


def _bound(df: DataFrame, order: list[str], row: Row) -> Column:
    """A sampled row as a literal to compare ``order_value`` with."""
    return F.struct(*[
        f for c, v in zip(order, row) for f in (F.lit(v is None), F.lit(v).cast(df.schema[c].dataType))
    ])


def _leading(df: DataFrame, order: list[str], low: Row | None, high: Row | None) -> Column:
    """What the bounds say of the first order column alone, which a scan can use to skip files."""
    first, kind = F.col(quoted(order[0])), df.schema[order[0]].dataType
    said = F.lit(True)
    if low is not None and low[0] is not None:
        said = said & (first.isNull() | (first >= F.lit(low[0]).cast(kind)))
    if high is not None and high[0] is not None:
        said = said & (first <= F.lit(high[0]).cast(kind))
    return said


def _between(df: DataFrame, order: list[str], low: Row | None, high: Row | None) -> Column:
    value, inside = order_value(order), F.lit(True)
    if low is not None:
        inside = inside & (value >= _bound(df, order, low))
    if high is not None:
        inside = inside & (value < _bound(df, order, high))
    return inside


def page_of(df: DataFrame, order: list[str], offset: int, limit: int | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in ascending order, or all from ``offset`` on.

    Where the page begins and ends is found by counting: a sample tells about where, one pass
    counts the rows below and inside, until a band is left that is little more than the page. Only
    the band is numbered. Rows that are alike in ``order`` follow each other by their other columns. The
    input is read several times: pass a table, not a costly plan.
    """
    names = [quoted(c) for c in order]
    total = df.count()
    first = min(offset, total)
    # Of an open page the band holds the beginning only.
    last = min(first + (1 if limit is None else limit), total)
    low: Row | None = None
    high: Row | None = None
    below, rows = 0, total
    while rows > BAND_ROWS + (last - first):
        band = df.where(_leading(df, order, low, high) & _between(df, order, low, high))
        sample = band.select(*names).sample(min(1.0, SAMPLE / rows), seed=7).orderBy(*in_order(order)).limit(4 * SAMPLE).collect()
        margin = 2 * math.isqrt(len(sample)) + 1
        left = (first - below) * len(sample) // rows - margin
        right = -(-(last - below) * len(sample) // rows) + margin
        to_low = sample[left] if 0 <= left < len(sample) else low
        to_high = sample[right] if 0 <= right < len(sample) else high
        under, inside = band.agg(
            F.count_if(~_between(df, order, to_low, None)), F.count_if(_between(df, order, to_low, to_high))
        ).first()
        if below + under > first:
            to_low, under, inside = low, 0, inside + under
        if below + under + inside < last:
            to_high, inside = high, rows - under
        if inside > rows / 2:
            break
        low, high, below, rows = to_low, to_high, below + under, inside
    band = df.where(_leading(df, order, low, high) & _between(df, order, low, high))
    every = with_ties(df, order)
    numbered = number_rows(band, [], every, number="_number", size="_size")
    wanted = F.col("_number") > first - below
    if limit is not None:
        wanted = wanted & (F.col("_number") <= last - below)
    page = numbered.where(wanted).drop("_number", "_size")
    if limit is None and high is not None:
        page = page.unionByName(df.where(_leading(df, order, high, None) & _between(df, order, high, None)))
    return page.orderBy(*in_order(every))
