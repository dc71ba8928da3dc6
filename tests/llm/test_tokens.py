"""Token counts and token shards against the libraries themselves."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import sentencepiece
import tokenizers

from tests.conftest import DATA
from tidemark.llm import token_counts, token_shards
from tidemark.llm.queries import QUERIES, vocabulary
from tidemark.llm.wavelet import WaveletMatrix

PIECES, WORDS = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")
ALPHABET = "ab  \t\n▁é<s></s>ﬁ́\x00日本😀<unk><0x41>\r<|endoftext|>'S's\x85\xa0\x1cΣİ.,!the "


def odd_texts(n: int) -> list[str]:
    rng = random.Random(4)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*made, "", " ", "\n", " a", "a ", "<|endoftext|>x", "<|startoftext|> y", "ab" * 5000, "İstanbul. straße, ÀÉ!!"]


def test_counts_equal_the_library():
    counts, model = token_counts.table(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts(3000):
        assert token_counts.count_text(text, counts) == len(model.encode(text)), ascii(text)


def test_counts_survive_a_full_memory(monkeypatch, texts):
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 5)
    counts, model = token_counts.MergeTable(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for _, text in texts[:20]:
        assert token_counts.count_text(text, counts) == len(model.encode(text))


def test_count_query(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, QUERIES["op8_token_counts"](spark, DATA).collect()))
    want = [(i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in texts]
    assert got == want


def test_counts_of_odd_rows(spark, odd_docs, no_docs):
    rows = token_counts.count_tokens(odd_docs, PIECES, limit=3).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 0, False)}
    assert sum(r["doc_id"] == 1 and r["over_limit"] for r in rows) == 2
    assert token_counts.count_tokens(no_docs, PIECES).collect() == []


def test_encoder_equals_the_library(monkeypatch):
    tokenizer = tokenizers.Tokenizer.from_file(WORDS)
    texts = odd_texts(3000)
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    for kept in (1_000_000, 3):
        monkeypatch.setattr(token_shards, "KEPT_CHUNKS", kept)
        monkeypatch.setattr(token_shards, "KEPT_WORDS", kept)
        encoder = token_shards.ChunkEncoder(WORDS)
        got = [ids.tolist() for at in range(0, len(texts), 500) for ids in encoder.encode(texts[at : at + 500], 2)]
        assert got == want


@pytest.mark.parametrize("ids", [[], [0], [7] * 1000, [70_000, 1, 0, 70_000], list(range(600)), [49_407, 0, 2, 2]])
def test_wavelet_matrix(ids):
    ids = np.array(ids, np.uint32)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
    assert matrix.decode().tolist() == ids.tolist()
    assert [matrix.access(i) for i in range(len(ids))] == ids.tolist()
    for token in {*ids.tolist()[:20], 5, 1 << 40}:
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert [matrix.select(token, k) for k in range(len(places))][:40] == places.tolist()[:40]
        assert matrix.count(token, 1, max(1, len(ids) // 2)) == (ids[1 : max(1, len(ids) // 2)] == token).sum()
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_shard_query(spark, texts):
    tokenizer = tokenizers.Tokenizer.from_file(WORDS)
    want, at = [], 0
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op2_token_shards"](spark, DATA).collect())) == want


def test_shards_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    path = str(tmp_path / "shards")
    token_shards.write_shards(odd_docs, path, WORDS, shard_tokens=4)
    rows = token_shards.read_shards(spark, path).orderBy("start").collect()
    assert len(rows) == odd_docs.count()
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]]).tolist()[:-1]
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 8]  # rows without an id come first
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 5))
    stored = {r["doc_id"]: list(r["ids"]) for r in token_shards.read_ids(spark, path).where("doc_id = 6").collect()}
    assert stored[6] == tokenizers.Tokenizer.from_file(WORDS).encode("the cat SAT on the mat and looked at the dog.", add_special_tokens=False).ids + [2]
    ends = sorted(r["position"] for r in token_shards.token_occurrences(spark, path, 2).collect())
    assert len(ends) >= len(rows) and {r["start"] + r["n_tokens"] - 1 for r in rows} <= set(ends)
    token_shards.write_shards(no_docs, path + "-none", WORDS)
    assert token_shards.read_shards(spark, path + "-none").collect() == []
