"""SimHash: fingerprints and components against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.llm import simhash


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").replace(
        "\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    runs = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, reach=2):
    names = list(range(len(prints)))

    def find(x):
        while names[x] != x:
            x = names[x]
        return x

    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(np.array(prints[:i], np.uint64) ^ np.uint64(p)) <= reach):
            a, b = find(i), find(int(j))
            names[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(prints))]


def expected(data):
    prints = [plain_print(text) for _, text in data]
    group = plain_components(prints)
    least = {}
    for (key, _), g in zip(data, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    return sorted(((k, f"{p:016x}", least.get(g)) for (k, _), p, g in zip(data, prints, group)), key=repr)


@pytest.mark.parametrize("shard", [2048, 10])
def test_near_duplicates_equal_a_plain_version(spark, rows, shard):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(simhash.near_duplicates(docs, shard=shard)) == expected(data)


def some_prints(n=3000, dense=1500, seed=3):
    """Random fingerprints, chains of small steps, and one dense group."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    steps = base[:200]
    chains = [steps := steps ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for _ in range(6)]
    group = base[0] ^ (np.uint64(1) << rng.integers(0, 64, dense).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, dense).astype(np.uint64))
    return np.unique(np.concatenate([base, *chains, group, group ^ (np.uint64(1) << rng.integers(0, 64, dense).astype(np.uint64))]))


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_trees_lose_no_link(shards):
    prints = some_prints()
    tree = simhash.grow(prints[::3], shards, 2)
    parent = np.arange(len(prints))
    owned = np.zeros(len(prints), int)
    for _, own, guests in tree.send(prints, 2):
        owned[own] += 1
        both = np.concatenate([own, guests])
        root = simhash.forest(prints[own], prints[guests])
        simhash._unite(parent, both, both[root])
    assert (owned == 1).all()
    got = simhash._roots(parent, np.arange(len(prints)))
    assert got.tolist() == plain_components(prints.tolist())


def test_dense_groups_give_few_links(spark):
    prints = some_prints(200, 20_000)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print bigint")
    simhash.ship(spark)
    tree = simhash.routing_tree(df, len(prints), shard=1000)
    assert tree.shards > 1
    assert simhash.near_links(df, tree).count() <= 20 * len(prints)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = ("Lorem ipsum\tdolor SIT amet " * 999 + "É ü").encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 100)
    assert simhash.fingerprint(text) == whole == plain_print(text.decode()).to_bytes(8)


def test_odd_rows(rows, odd_docs, no_docs):
    data = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(simhash.near_duplicates(odd_docs)) == expected(data)
    assert simhash.near_duplicates(no_docs).count() == 0
    nameless = odd_docs.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert {r["component_id"] for r in simhash.near_duplicates(nameless).collect()} == {None}
