"""Small files and folder listings on whatever file system a path names."""

from __future__ import annotations

import time

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def depth(spark: SparkSession, path: str) -> int:
    """Steps from the file system's root to the names inside a folder."""
    fs, at = _open(spark, path)
    inside = fs.makeQualified(at).toUri().getPath().strip("/")
    return 1 + len(inside.split("/") if inside else [])


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none when the folder is absent."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at))


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _open(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; gives whether it was written.

    The file system decides between two writers at once, by refusing to create
    what exists. A reader may meet a file that is not written to its end.
    """
    fs, at = _open(spark, path)
    try:
        stream = fs.create(at, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(at):
            return False
        raise
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    return True


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Move a file; gives whether the file system did."""
    fs, at = _open(spark, path)
    return fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    fs, at = _open(spark, path)
    return time.time() - fs.getFileStatus(at).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 when it is absent."""
    fs, at = _open(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _open(spark, path)
    fs.delete(at, True)


