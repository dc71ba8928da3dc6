"""Spelling variants: the trie against all pairs, whole results against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import DATA
from tidemark.llm import spelling


def plain_words(rows, damage=199):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain_one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [x for x in words if x != w and plain_one_edit(w, x)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_variants_equal_a_plain_version(spark, rows):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = rows(spelling.variants(docs))
    assert found == plain_variants(plain_words(data))
    assert any(r[1] for r in found)


def test_small_subtrees_give_the_same(spark, rows):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert rows(spelling.variants(docs, subtree=3)) == rows(spelling.variants(docs))


def test_chains_of_forms(spark, rows):
    chain = ["abcdefgh", "abcdefgi", "abcdefii", "abcdeiii", "abcdiiii"]
    data = [(i, f" {w} ") for n, w in enumerate(chain) for i in range(5 ** (n + 1))]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    found = rows(spelling.variants(docs, damage=1 << 40))
    assert [r[2] for r in found] == ["abcdiiii"] * 5
    assert found == plain_variants(plain_words(data, damage=1 << 40))


def test_trie_finds_all_near_words(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 5000)
    rng = random.Random(5)
    words = {"".join(rng.choice("abeinrstàñÿ") for _ in range(rng.randint(6, 8))) for _ in range(400)}
    for w in sorted(words)[:200]:
        at = rng.randrange(len(w))
        words |= {w[:at] + rng.choice("aeé") + w[at:], w[:at] + "z" + w[at + 1 :]}
    words = sorted(words)
    every = np.arange(len(words))
    a, b = spelling.Words(words).near(every, every)
    want = {(x, y) for x in words for y in words if x != y and plain_one_edit(x, y)}
    assert {(words[i], words[j]) for i, j in zip(a, b)} == want and len(a) == len(want)


@pytest.mark.parametrize("cut", spelling.CUTS)
def test_near_words_are_within_budget_for_every_key(cut):
    pairs = [("ananas", "ananaz"), ("ananas", "annanas"), ("ananas", "anans"), ("élèves", "elèves"), ("zzzzzz", "zzzzzzz")]
    for a, b in pairs:
        assert spelling.vector(b, cut) in list(spelling.within_budget(spelling.vector(a, cut)))


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "wonder wonders  wonderful, Größe-übermut " * 50
    whole = spelling.runs_of(text)
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert spelling.runs_of(text) == whole == Counter(x for x in re.findall("[A-Za-zÀ-ÿ]+", text) if len(x) >= 6)


def test_odd_rows(rows, odd_docs, no_docs):
    data = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(spelling.variants(odd_docs)) == plain_variants(plain_words(data))
    assert spelling.variants(no_docs).count() == 0
