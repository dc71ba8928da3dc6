"""Names and types of a dataset's columns: list, infer, compare, apply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import exactly, quoted
from tidemark.functions.servicetypes import (
    looks_like_date,
    looks_like_datetime,
    looks_like_double,
    looks_like_long,
    parse_as,
    service_type,
)

Columns = list[tuple[str, str]]


def columns_of(df: DataFrame) -> Columns:
    """Name and service type of every column, in order."""
    return [(f.name, service_type(f.dataType)) for f in df.schema.fields]


def dataset_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, service type, rows of the dataset."""
    fields = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.lit(t).alias("type"))
        for i, (n, t) in enumerate(columns_of(df), start=1)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.inline(F.array(*fields)), "rows")


def infer_types(df: DataFrame, numbers: bool = False) -> DataFrame:
    """One row per column: position, name and inferred service type.

    Text columns are dates or times when every value present reads as one (a time without an
    offset is UTC); with ``numbers`` they may be LONG or DOUBLE too, when no
    value is written with zeros in front or has more digits than the type gives back. A type
    holds for a column when as many values fit it as there are, so counts of parts add up. Other columns have the type
    of their class. The texts are checked in one pass, a cell at a time, so a
    wide table takes no more code than a narrow one; tasks send on counts only.
    """
    columns = columns_of(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    place = {name: i for i, name in enumerate(texts)}
    known = df.sparkSession.createDataFrame(
        [(i, n, t, place.get(n)) for i, (n, t) in enumerate(columns, start=1)],
        "position int, name string, class string, place int",
    )
    if not texts:
        return known.select("position", "name", F.col("class").alias("type"))
    # Each kind and the type it stands for; a value may be of several.
    tests = {
        "_datetime": (looks_like_datetime, "DATETIME"),
        "_date": (looks_like_date, "DATE"),
    }
    if numbers:
        tests |= {"_long": (looks_like_long, "LONG"), "_double": (looks_like_double, "DOUBLE")}
    cells = df.select(F.posexplode(F.array(*exactly(texts))).alias("place", "text"))
    counts = (
        cells.where(F.col("text").isNotNull())
        .groupBy("place")
        .agg(F.count("text").alias("present"), *[F.count_if(test(F.col("text"))).alias(k) for k, (test, _) in tests.items()])
    )
    chosen = F.coalesce(*[F.when(F.col(k) == F.col("present"), F.lit(kind)) for k, (_, kind) in tests.items()], "class")
    # One row per column on either side.
    return known.join(F.broadcast(counts), "place", "left").select("position", "name", chosen.alias("type"))


def inferred_columns(df: DataFrame, numbers: bool = False) -> Columns:
    """The result of :func:`infer_types` as a list, one entry per column."""
    return [(r["name"], r["type"]) for r in infer_types(df, numbers).orderBy("position").collect()]


def schema_changes(old: Columns, new: Columns) -> list[tuple[str, str, str | None, str | None]]:
    """What turns ``old`` into ``new``: (change, name, old type, new type).

    Order counts: a shared column whose place among the shared ones differs
    has moved.
    """
    before, after = dict(old), dict(new)
    shared_before = [n for n, _ in old if n in after]
    shared_after = [n for n, _ in new if n in before]
    changes: list[tuple[str, str, str | None, str | None]] = []
    changes += [("removed", n, t, None) for n, t in old if n not in after]
    changes += [("added", n, None, t) for n, t in new if n not in before]
    changes += [("retyped", n, before[n], after[n]) for n in shared_before if before[n] != after[n]]
    changes += [("moved", n, before[n], after[n]) for n, m in zip(shared_before, shared_after) if n != m]
    return changes


def schema_diff(spark: SparkSession, old: Columns, new: Columns) -> DataFrame:
    schema = "change string, name string, old_type string, new_type string"
    return spark.createDataFrame(schema_changes(old, new), schema)


def cast_typed(df: DataFrame, types: dict[str, str], any_format: bool = False) -> DataFrame:
    """Read text columns as their declared service types; bad values become null."""
    return df.select(
        *[
            parse_as(F.col(quoted(c)), types[c], any_format).alias(c) if c in types else F.col(quoted(c))
            for c in df.columns
        ]
    )
