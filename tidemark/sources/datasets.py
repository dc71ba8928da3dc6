"""Reading datasets: CSV downloads, JSON listings, SQL on one dataset."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import exactly, friendly_names
from tidemark.operators.relational import page_rows
from tidemark.operators.schema import cast_typed, inferred_columns
from tidemark.session import written
from tidemark.sources import publish, storage
from tidemark.sources.csvformat import BAD, CSV_FORMAT, MISSING, write_options as write_options
from tidemark.sources.csvrecords import line_facts, read_records

def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    friendly: bool = False,
    multi_line: bool = True,
    bad_records: str | None = None,
) -> DataFrame:
    """A dataset kept as CSV, ``\\N`` for missing values; empty text stays text.

    Without ``schema`` names come from the header and types from one pass over
    all values; with it, values that do not fit their type become null.
    With ``multi_line`` texts may hold line breaks: one pass looks for them, and where there
    are any, or several files with headers, records are put together from ranges that are read by all tasks,
    each file's columns by its own header; see ``csvrecords``. The rows are then written once.

    A record with more or fewer cells than the first one fails the scan, or with ``bad_records``
    is kept whole in a column of that name, which is null for all other records; its cells are what
    could be read of it.
    """
    names = schema.names if schema is not None else None
    broken, files = line_facts(spark, path) if multi_line else (False, 0)
    if broken or (header and files > 1):
        cells, names = read_records(spark, path, header, names)
        places = [f"c{i}" for i in range(len(names))]
    else:
        reader = spark.read.options(**CSV_FORMAT)
        if names is None:
            first = reader.option("header", False).csv(path).first()
            if first is None:
                raise ValueError(f"no header in {path}")
            names = [n or "" for n in first] if header else [f"column_{i}" for i in range(1, len(first) + 1)]
        places = [f"c{i}" for i in range(len(names))]
        kinds = ", ".join([*(f"{p} string" for p in places), f"{BAD} string"])
        cells = reader.option("header", header).option("columnNameOfCorruptRecord", BAD).schema(kinds).csv(path)
    # The reader gives null for a cell without any character, which is empty text.
    good = F.col(BAD).isNull()
    if bad_records is None:
        problem = F.raise_error(F.concat(F.lit(f"not {len(names)} cells: "), F.substring(BAD, 1, 200)))
        good = F.when(good, True).otherwise(problem.cast("boolean"))
    texts = cells.select(
        *[F.when(F.col(p).isNull() & good, "").when(F.col(p) != MISSING, F.col(p)).alias(p) for p in places],
        # Spark refuses queries that need no other column than this one.
        *([F.when(F.length(F.coalesce(places[0], F.lit(""))) >= 0, F.col(BAD)).alias(BAD)] if bad_records else []),
    )
    if schema is not None:
        typed = texts.select(*[F.col(p).try_cast(f.dataType).alias(p) for p, f in zip(places, schema.fields)], *texts.columns[len(places) :])
    else:
        kinds = dict(inferred_columns(texts.select(*places), numbers=True))
        typed = cast_typed(texts, kinds, any_format=True)
    shown = friendly_names(names) if friendly else names
    return typed.toDF(*shown, *([bad_records] if bad_records else []))


def scan_json_pages(
    spark: SparkSession, path: str, schema: T.StructType | str, page_per_line: bool = False
) -> DataFrame:
    """A listing landed as pages, each an array of records, as one table.

    A page is a file, or a line of a file; files of lines are split among
    tasks. An unreadable page fails the scan.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", not page_per_line)
        .option("mode", "FAILFAST")
        .json(path)
    )


def dataset_listing(spark: SparkSession, root: str, limit: int = 0, offset: int = 0) -> DataFrame:
    """Name, column count and row count of every dataset below ``root``, parquet or published.

    Sorted by name and paged. Rows of all datasets are counted by one scan that
    reads no column, whatever their schemas are; only those with deltas not yet merged are read
    themselves. The columns of a published dataset are told by its state file.
    """
    root = root.rstrip("/")
    names = [n for n in storage.children(spark, root) if not n.startswith(("_", "."))]

    def look(name: str) -> tuple[int, list[str], int | None]:
        """Columns, the folders to count, and the rows where they are known already."""
        state = publish.read_state(spark, f"{root}/{name}")
        if state is None:
            return len(spark.read.parquet(f"{root}/{name}").columns), [f"{root}/{name}"], None
        width = len(json.loads(state.schema)["fields"])
        if state.deltas:
            return width, [], publish.read_published(spark, f"{root}/{name}", state).count()
        return width, publish.part_folders(f"{root}/{name}", state), None

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(look, names))
    widths = [(n.removesuffix(".parquet"), width, rows) for n, (width, _, rows) in zip(names, found)]
    folders = [f for _, some, _ in found for f in some]
    datasets = spark.createDataFrame(widths, "name string, columns int, known bigint")
    steps = F.split(F.parse_url(F.col("_metadata.file_path"), F.lit("PATH")), "/")
    folder = F.url_decode(F.replace(steps[storage.depth(spark, root)], F.lit("+"), F.lit("%2B")))
    scan = spark.read.schema("_none int").option("recursiveFileLookup", True)
    files = scan.parquet(*folders) if folders else spark.createDataFrame([], "_none int").withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    counted = (
        files
        .groupBy(F.regexp_replace(folder, r"\.parquet$", "").alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    listing = datasets.join(counted, "name", "left").select(
        "name", "columns", F.coalesce("known", "rows", F.lit(0)).alias("rows")
    )
    # Paging reads its input more than once.
    return page_rows(written(listing, "listing") if limit or offset else listing, ["name"], limit, offset)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dataset_sql(
    spark: SparkSession,
    query: str,
    path: str,
    read: Callable[[SparkSession, str], DataFrame] = read_parquet,
) -> DataFrame:
    """Run SQL over one stored dataset, named ``table`` in the text. ``read``
    says how it is stored (``read_published``, ``scan_csv``, ...).

    The name lives in a session of its own, with the same settings, so queries
    on different datasets can run side by side.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    read(own, path).createOrReplaceTempView("table")
    return own.sql(query)


def sql_rows_json(result: DataFrame) -> DataFrame:
    """A query result untyped: one list of texts per row, as it travels on the wire."""
    return result.select(F.array(*[c.cast("string") for c in exactly(result.columns)]).alias("row"))
