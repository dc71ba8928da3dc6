"""CSV records of files that are read in byte ranges, though their texts may hold line breaks.

A line break ends a record where an even number of quotes stands before it in the file. Every
range is read by its own task, which knows the parity inside the range only; a prefix over
the ranges' parities tells each with which parity it begins, and how many records begin
before it. Lines that are a record of their own stay where they are; the lines of longer records
meet by file and record number.
"""

from __future__ import annotations

import csv
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import written
from tidemark.sources.csvformat import BAD, CSV_FORMAT, MISSING

# Files of one dataset may have so many different headers.
MOST_HEADERS = 1000


def has_odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def line_facts(spark: SparkSession, path: str) -> tuple[bool, int]:
    """(whether a record may hold a line break, the number of files), by one pass."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    files = lines.groupBy("file").agg(F.count_if(has_odd_quotes(F.col("value"))).alias("odd"))
    found = files.agg(F.coalesce(F.sum("odd"), F.lit(0)), F.count(F.lit(1))).first()
    return found[0] > 0, found[1]


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row, line, odd: every line with its range and its place in it, written once."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    return written(lines.withColumn("odd", has_odd_quotes(F.col("line"))), "csv-lines")


def records_of(lines: DataFrame) -> DataFrame:
    """file, record (from 1), text of placed lines. Blank lines between records are none.

    A quote that is never closed makes the rest of its file one record.
    """
    block = Window.partitionBy("file", "block").orderBy("row")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2
    # Where the range begins outside a text, records begin at the lines with 0, else at those with 1.
    ranged = lines.withColumn("inside", inside)
    counted = ranged.select(
        "*", *[F.sum((F.col("inside") == p).cast("bigint")).over(so_far).alias(f"begun{p}") for p in (0, 1)]
    )
    totals = ranged.groupBy("file", "block").agg(
        (F.sum(F.col("odd").cast("int")) % 2).alias("parity"),
        *[F.count_if(F.col("inside") == p).alias(f"all{p}") for p in (0, 1)],
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = totals.withColumn("open", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    starts = opened.withColumn("own", F.when(F.col("open") == 0, F.col("all0")).otherwise(F.col("all1"))).select(
        "file", "block", "open", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("first")
    )
    begun = F.when(F.col("open") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    numbered = counted.join(starts, ["file", "block"]).withColumn("record", F.col("first") + begun)
    alone = (F.col("inside") == F.col("open")) & ~F.col("odd")
    whole = numbered.where(alone).select("file", "record", F.col("line").alias("text"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "line")))
    joined = numbered.where(~alone).groupBy("file", "record").agg(
        F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("text")
    )
    text = F.regexp_replace("text", "\r$", "").alias("text")
    return whole.unionByName(joined).select("file", "record", text).where("text <> ''")


def _wide(width: int) -> str:
    return ", ".join([*(f"c{i} string" for i in range(width)), f"{BAD} string"])


def _parsed(width: int) -> Column:
    options = {**CSV_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    return F.from_csv("text", F.lit(_wide(width)), options)


def _placed(names: list[str]) -> list[tuple[str, int]]:
    """Each name with how often it stood before, so that repeated names are told apart."""
    seen: Counter = Counter()
    out = []
    for name in names:
        out.append((name, seen[name]))
        seen[name] += 1
    return out


def read_records(spark: SparkSession, path: str, header: bool, names: list[str] | None) -> tuple[DataFrame, list[str]]:
    """(c0, c1, ... and the bad record, the columns' names) of all records of all files.

    With a header, each file's columns are found by its own header's names; a column that a file
    lacks is missing in its rows. Given ``names`` stand for the columns in their order.
    """
    records = written(records_of(placed_lines(spark, path)), "csv-records")
    # Blank lines before a header are no records, so it need not be number 1.
    tops = records.groupBy("file").agg(F.min("record").alias("top"))
    if not header:
        if names is None:
            first = records.orderBy("file", "record").limit(1).collect()
            if not first:
                raise ValueError(f"no record in {path}")
            names = [f"column_{i}" for i in range(1, 1 + len(next(csv.reader(first[0]["text"].splitlines(True)))))]
        return records.select(_parsed(len(names)).alias("x")).select("x.*"), names

    heads = written(
        records.join(tops, "file").where("record = top").select("file", "top", F.col("text").alias("head")), "csv-headers"
    )
    kinds = heads.groupBy("head").agg(F.min("file").alias("file")).orderBy("file").limit(MOST_HEADERS + 1).collect()
    if not kinds:
        raise ValueError(f"no header in {path}")
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers in {path}")
    layouts = {k["head"]: next(csv.reader(k["head"].splitlines(True))) for k in kinds}
    wanted: list[tuple[str, int]] = []
    for own in layouts.values():
        wanted += [n for n in _placed(own) if n not in wanted]
    if names is not None and (len(layouts) > 1 or len(names) != len(wanted)):
        raise ValueError(f"the headers in {path} do not fit {len(names)} columns")
    body = records.join(heads, "file").where("record > top")
    cells = None
    for head, own in layouts.items():
        place = {n: i for i, n in enumerate(_placed(own))}
        parsed = body.where(F.col("head") == head).select(_parsed(len(own)).alias("x")).select(
            *[(F.col(f"x.c{place[n]}") if n in place else F.lit(MISSING)).alias(f"c{i}") for i, n in enumerate(wanted)], f"x.{BAD}"
        )
        cells = parsed if cells is None else cells.unionByName(parsed)
    return cells, names or [n for n, _ in wanted]
