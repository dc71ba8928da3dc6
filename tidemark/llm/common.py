"""Helpers the corpus operators share: shipping code, text batches, saved tables."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_dir

# Bytes of text a task handles at once, whatever the size of an Arrow batch.
SLICE_BYTES = 1 << 20
# White space of the word contracts: blank and the bytes 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application.

    Python tasks import it by name, and a cluster need not have it installed.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; other columns can't clash."""
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later jobs start there,
    also after executors were lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give freed memory back to the system where the C library can: workers live on after their task."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps what it has


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has at most SLICE_BYTES (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        ends = utf8(values)[1]
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1
            stop = min(max(stop, at + 1), batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as (bytes, offsets); null counts as empty.

    Offsets start at 0 and have one entry more than there are rows.
    """
    if values.null_count:
        values = values.fill_null("")
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    kind = np.int64 if wide else np.int32
    size = np.dtype(kind).itemsize
    at = np.frombuffer(offsets, dtype=kind, count=len(values) + 1, offset=values.offset * size).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def batch_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
