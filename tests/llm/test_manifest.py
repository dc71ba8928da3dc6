"""Merkle manifest: against a plain tree, on odd rows, and its coordinates at every size."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import MANIFEST_FIELDS


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def plain_path(levels: list[list[str]], pos: int) -> list[tuple[str, str]]:
    path = []
    for level in levels[:-1]:
        first = pos // 16 * 16
        path.append(("".join(level[first:pos]), "".join(level[pos + 1 : first + 16])))
        pos //= 16
    return path


def plain_manifest(rows) -> list[tuple]:
    """Of (doc_id, source, lang, n_chars, text): the columns of op11, by sorting everything."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees, starts = [], []
    for group in order:
        rows = []
        for row in groups[group]:
            other = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                other = (*row[:4], row[4].translate(low))
            rows.append((row[0] is not None, row[0] or 0, plain_leaf(row), plain_leaf(other), row[0]))
        rows.sort()
        trees.append(plain_levels([r[2] for r in rows]))
        starts.append([(r[4], r[3]) for r in rows])
    top = plain_levels([tree[-1][0] for tree in trees])
    out = []
    for g, tree in enumerate(trees):
        above = plain_path(top, g)
        for pos, (doc_id, start) in enumerate(starts[g]):
            path = plain_path(tree, pos) + above
            node = start
            for before, after in path:
                node = sha(before + node + after)
            proof = sha("".join(before + after for before, after in path))
            out.append((doc_id, tree[0][pos], tree[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def built(docs, rows):
    return rows(merkle.manifest(docs, MANIFEST_FIELDS), *NAMES)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2, 16, 17, 1, 256, 257, 300], [5] * 40])
def test_manifest_equals_a_plain_tree(spark, rows, sizes):
    data = [
        (31 * i + 7 * g, f"s{g:03}", "en", i, f"Some Text {i} of {g}" if i % 3 else f"plain {i}")
        for g, n in enumerate(sizes) for i in range(n)
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = built(docs, rows)
    assert found == plain_manifest(data)
    assert any(not r[6] for r in found) or sizes in ([1], [1, 1])


def test_far_apart_and_negative_ids(spark, rows):
    ids = [-(1 << 62), -5, -1, 0, 1, 63, 64, 1023, 1024, 1 << 22, (1 << 34) + 3, (1 << 62) + 9]
    data = [(i, "a" if i % 2 else None, None, None, "X") for i in ids]
    docs = spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert built(docs, rows) == plain_manifest(data)


def test_odd_rows(spark, rows, odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("bigint"))
    data = [tuple(r) for r in docs.select(*MANIFEST_FIELDS).collect()]
    assert built(docs, rows) == plain_manifest(data)


def test_no_rows(no_docs):
    assert merkle.manifest(no_docs.withColumn("n_chars", F.lit(1)), MANIFEST_FIELDS).count() == 0


def test_tampering_is_found(spark):
    data = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(200)]
    docs = spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    bad = {r["doc_id"] for r in merkle.manifest(docs, MANIFEST_FIELDS).where("NOT verified").collect()}
    assert bad == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0}
