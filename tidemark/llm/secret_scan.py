"""Secret scans over a blob ledger.

Every version of a text is a blob, addressed by its SHA-256. The ledger holds
the pairs of blob and rule version that were scanned, with what was found, so a
run scans only the pairs it has not seen, once for all paths that share a blob,
and joins the findings back to every path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import batch_of, documents, saved, ship, slices
from tidemark.session import scratch_dir
from tidemark.sources import storage


class Rule(NamedTuple):
    """A kind of secret: a pattern, the group whose length counts, its least length."""

    kind: str
    pattern: re.Pattern[str]
    group: int
    least: int


# The base kinds in their order, then the kinds added here. A hex run
# is a match as a whole, so the pattern may leave out the short ones itself.
BASE_RULES = (
    Rule("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    Rule("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
MORE_RULES = (
    Rule("private_key", re.compile(r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"), 0, 1),
    Rule("jwt", re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), 0, 32),
    Rule("hub_token", re.compile(r"gh[pousr]_[A-Za-z0-9]+"), 0, 24),
    Rule("url_login", re.compile(r"[a-z]+://[^\s:/@]{1,64}:[^\s:/@]{1,128}@"), 0, 1),
)
RULES = BASE_RULES + MORE_RULES
# Raise with every change of the rules: blobs are then scanned again.
RULE_VERSION = 1

FOUND = pa.schema([("blob", pa.string()), ("spans", pa.list_(pa.string()))])
LEDGER = "blob string, spans array<string>, rule_version int"


def spans_of(text: str, rules: tuple[Rule, ...] = RULES) -> list[str]:
    """``kind:start:end`` of every secret, by start, then by the rules' order."""
    found = []
    for order, rule in enumerate(rules):
        for match in rule.pattern.finditer(text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append((match.start(), order, f"{rule.kind}:{match.start()}:{match.end()}"))
    return [span for _, _, span in sorted(found)]


def blobs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob: the address of each row's text; null is the empty text."""
    rows = documents(docs, id_col, text_col)
    return rows.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("blob"))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    if storage.exists(spark, path):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def update_ledger(
    docs: DataFrame, paths: DataFrame, ledger_path: str, rule_version: int = RULE_VERSION,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Scan the blobs of ``docs`` that the ledger lacks under this rule version.

    ``paths`` is ``blobs(docs)``, written. Of the rows that share a blob the one
    of the smallest id is read. Findings are appended in one commit, so a run
    that dies leaves the ledger as it was.
    """
    spark = docs.sparkSession
    ship(spark)
    done = _ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob")
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id")).join(done, "blob", "left_anti")
    rows = documents(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch_of(FOUND, batch.column("blob"), [spans_of(t) for t in batch.column("text").to_pylist()])

    same = (rows["blob"] == unseen["blob"]) & rows["doc_id"].eqNullSafe(unseen["doc_id"])
    picked = rows.join(unseen.hint("shuffle_hash"), same, "left_semi")
    found = picked.select("text", "blob").mapInArrow(scan, "blob string, spans array<string>").dropDuplicates(["blob"])
    found.withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(ledger_path)


def scan_secrets(
    docs: DataFrame, ledger_path: str | None = None, rule_version: int = RULE_VERSION,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, blob, n_assign, n_access, n_hex, base_sha256, spans: one row per input row.

    Offsets are code points, ends exclusive. A null or empty text has no
    spans. Repeated rows, and rows of a null id, get a row each. Without
    a ledger everything is scanned once; an existing one is extended.
    """
    spark = docs.sparkSession
    ledger_path = ledger_path or scratch_dir(spark, "secret-ledger")
    paths = saved(blobs(docs, id_col, text_col), "secret-paths")
    update_ledger(docs, paths, ledger_path, rule_version, id_col, text_col)
    found = _ledger(spark, ledger_path).where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    rows = paths.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<string>")))
    kind = lambda span: F.substring_index(span, ":", 1)
    base = F.filter("spans", lambda s: kind(s).isin(*[r.kind for r in BASE_RULES]))
    count = lambda name: F.size(F.filter("spans", lambda s: kind(s) == name)).cast("bigint")
    return rows.select(
        "doc_id", "blob", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans"),
    )
