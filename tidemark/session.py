"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what splits a skewed join side and merges small
# partitions at run time, so every job here relies on it being on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Scratch folders of local sessions that name none, by application.
_local_roots: dict[str, str] = {}


def build_session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Pass further settings with underscores for dots
    (``spark_sql_shuffle_partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may do without ``spark.checkpoint.dir``: executors on
    other machines could not read a folder of the driver's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_roots.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tidemark-")
        _local_roots[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the scratch folder and read back: later jobs start there, also after
    executors were lost, and see what was written, also of columns that another run would fill otherwise."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
