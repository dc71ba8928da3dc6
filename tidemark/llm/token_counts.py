"""Token counts by heap-and-linked-list byte-pair merging.

A text's symbols are linked; the adjacent pair whose union is the
lowest-ranked piece is merged first, leftmost on ties, until no pair is a piece.
The count is the number of symbols minus the merges; a symbol the vocabulary
lacks counts as its UTF-8 bytes. No identifiers are made.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.common import batch_of, documents, ship, slices

SPACE_MARK = "▁"
# Counted words a worker keeps before it starts over.
KEPT_WORDS = 400_000
# Longer words are counted without being kept.
KEPT_LENGTH = 64

COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


class MergeTable(dict):
    """Token count per word, worked out on first use."""

    def __init__(self, path: str):
        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ranks: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.ranks[model.id_to_piece(i)] = -model.get_score(i)
        bytes_known = any(model.is_byte(i) for i in range(model.get_piece_size()))
        probes = (" a  b ", "Ａ́\tﬁ \n", "")
        plain = all(model.decode(model.encode(p)) == p for p in probes)
        crossing = any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in self.ranks)
        if not (bytes_known and plain) or crossing or any("\n" in p for p in self.ranks):
            raise ValueError(f"{path} rewrites texts or joins words, which this counter does not do")

    def __missing__(self, word: str) -> int:
        n = merged_length(word, self.ranks)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = n
        return n


# No piece reaches from a word's end into the next blank, or over a line break,
# so merging inside these stretches is merging in the whole text.
STRETCH = re.compile(f"\n|{SPACE_MARK}+[^{SPACE_MARK}\n]*|[^{SPACE_MARK}\n]+")


def merged_length(word: str, ranks: dict[str, float]) -> int:
    """Tokens left of ``word`` once every possible merge is made."""
    n = len(word)
    symbols: list[str] = list(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(word[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, 2))
    heapify(heap)
    merges = 0
    while heap:
        _, left, right, size = heappop(heap)
        joined = symbols[left] + symbols[right]
        if not symbols[left] or not symbols[right] or len(joined) != size:
            continue  # one of the two was merged meanwhile
        symbols[left], symbols[right] = joined, ""
        merges += 1
        follower = after[left] = after[right]
        if follower < n:
            before[follower] = left
            rank = ranks.get(joined + symbols[follower])
            if rank is not None:
                heappush(heap, (rank, left, follower, size + len(symbols[follower])))
        leader = before[left]
        if leader >= 0:
            rank = ranks.get(symbols[leader] + joined)
            if rank is not None:
                heappush(heap, (rank, leader, left, len(symbols[leader]) + size))
    unknown = sum(len(s.encode("utf-8")) - 1 for s in symbols if s and s not in ranks)
    return n - merges + unknown


_tables: dict[str, MergeTable] = {}


def table(path: str) -> MergeTable:
    if path not in _tables:
        _tables[path] = MergeTable(path)
    return _tables[path]


def count_text(text: str | None, counts: MergeTable) -> int:
    if not text:
        return 0
    return sum(map(counts.__getitem__, STRETCH.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))))


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per input row.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null and
    repeated rows stay repeated. Rows are independent: no shuffle, and a lost
    executor's rows are simply counted again.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table(model_path)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            tokens = [count_text(t, counts) for t in texts]
            sizes = [len(t.encode("utf-8")) if t else 0 for t in texts]
            yield batch_of(COUNTS, batch.column("doc_id"), sizes, tokens, [n > limit for n in tokens])

    return documents(docs, id_col, text_col).mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
