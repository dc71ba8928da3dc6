"""Benchmark decontamination by BM25 over an inverted index of test items.

Every passage (a window of words) of every training text is a query against the
items, all passages of a batch at once. Block-max WAND leaves out what cannot
reach the threshold: of an item's postings those of its commonest terms, up to a
share REST of its score, are not searched at all, and a block of items is
scored only for passages where the block maxima of the searched postings, with
that rest, reach the threshold. All items at or above the threshold are
retrieved, and each is verified by the word runs of its question and of its
answer, or of the whole item if it has no answer, that the text holds around the
passage.

Items longer than PIECE words are indexed in pieces of at most that many, so that
a copied piece always lies within one passage. Scores are shares of a piece's
score against itself, and the whole item is verified over a span of the text
that is at least as long as the item, so one threshold serves items of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import batch_of, documents, saved, ship, slices, utf8
from tidemark.llm.words import ALNUM, hashed_words, lower_latin, mix

# BM25's usual constants.
K1, B = 1.2, 0.75
# Words of a passage and from one passage's start to the next.
PASSAGE, STRIDE = 96, 32
# Words of an item that are scored together, at most: any such stretch of a text is in one passage.
PIECE = PASSAGE - STRIDE
# Share of a piece's own score a passage must reach to retrieve its item.
LEAST_SCORE = 0.5
# Share of the question's and the answer's word runs that the text must hold.
LEAST_QUESTION, LEAST_ANSWER = 0.6, 0.6
RUN = 3
# Words an answer needs to be verified by runs: a changed word takes RUN of them, and of
# fewer words it would take more than 1 - LEAST_ANSWER. A shorter one is verified by words.
LEAST_RUN_ANSWER = 10
BLOCK = 8
# Share of a piece's own score whose postings are left to the exact scoring.
REST = 0.25
# Items are indexed in parts of about this size, one broadcast and one scan each.
PART_BYTES = 16 << 20

FOUND = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_share", pa.float64()), ("answer_share", pa.float64()),
])
FOUND_SQL = "doc_id bigint, item_id bigint, score double, question_share double, answer_share double"


def question_and_answer(text: Column, share: float = 0.75) -> tuple[Column, Column]:
    """A text of one piece as question and answer: its first words and the rest."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\f\x0B]+"), lambda w: w != "")
    cut = F.ceil(F.size(words) * share).cast("int")
    join = lambda part: F.array_join(part, " ")
    return join(F.slice(words, 1, cut)), join(F.slice(words, cut + 1, F.size(words)))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, ends = utf8(texts)
    return hashed_words(lower_latin(data), ends, ALNUM)


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` words in a row."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(out)]
    return np.unique(mix(out))


def pieces(words: np.ndarray) -> list[np.ndarray]:
    """An item's words in even pieces of at most PIECE, one (empty) piece if there are none."""
    return np.array_split(words, max(1, -(-len(words) // PIECE)))


@dataclass
class ItemIndex:
    """Postings of the items' pieces by term, with the largest weight of each block of pieces."""

    items: np.ndarray
    # Per piece, the place of its item; per item, its words.
    owner: np.ndarray
    lengths: np.ndarray
    terms: np.ndarray
    # Blocks of the searched postings by term, and the least sum that a block needs.
    first: np.ndarray
    blocks: np.ndarray
    block_most: np.ndarray
    block_least: np.ndarray
    # Per piece: term numbers and weights.
    item_terms: list[np.ndarray]
    item_weights: list[np.ndarray]
    # Per item: the word runs of its question and of its answer.
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]

    def __post_init__(self) -> None:
        bits = max(12, int(np.ceil(np.log2(max(len(self.terms), 1) * 16))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        slot = (self.terms >> self.shift).astype(np.int64)
        self.slots[slot[::-1]] = np.arange(len(self.terms))[::-1]
        # Terms that share a slot with an earlier one are looked up by search.
        self.crowded = np.zeros(1 << bits, bool)
        self.crowded[slot[1:][slot[1:] == slot[:-1]]] = True

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """The term number of every word, -1 for words no item has."""
        if not len(self.terms):
            return np.full(len(words), -1, np.int64)
        slot = (words >> self.shift).astype(np.int64)
        term = self.slots[slot].astype(np.int64)
        hit = np.flatnonzero(term >= 0)
        found = self.terms[term[hit]] == words[hit]
        again = hit[~found & self.crowded[slot[hit]]]
        term[hit[~found]] = -1
        if len(again):
            place = np.minimum(np.searchsorted(self.terms, words[again]), len(self.terms) - 1)
            same = self.terms[place] == words[again]
            term[again[same]] = place[same]
        return term

    def open_blocks(self, passages: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) where the block maxima may reach the threshold; pairs are distinct."""
        sizes = self.first[terms + 1] - self.first[terms]
        place = np.repeat(self.first[terms], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cell = np.repeat(passages, sizes) * len(self.block_least) + self.blocks[place]
        cells, number = np.unique(cell, return_inverse=True)
        bounds = np.bincount(number, weights=self.block_most[place], minlength=len(cells))
        passage, block = np.divmod(cells, max(len(self.block_least), 1))
        reached = bounds >= self.block_least[block] - 1e-9
        return passage[reached], block[reached]

    def retrieve(self, block: int, terms: np.ndarray) -> list[tuple[int, float]]:
        """(piece, exact score) of a block's pieces at or above the threshold; ``terms`` may repeat."""
        present = np.zeros(len(self.terms), bool)
        present[terms] = True
        out = []
        for piece in range(block * BLOCK, min((block + 1) * BLOCK, len(self.owner))):
            score = float(self.item_weights[piece] @ present[self.item_terms[piece]])
            if score >= LEAST_SCORE - 1e-9:
                out.append((piece, score))
        return out


def build_index(ids: list[int], questions: list[str], answers: list[str], n_pieces: int, mean_words: float, frequency: dict[int, int] | None = None) -> ItemIndex:
    """Index a part of the items; counts are those of all pieces (this part's if not given)."""
    q_words, q_at = _words(pa.array(questions, pa.string()))
    a_words, a_at = _words(pa.array(answers, pa.string()))
    terms_of, counts_of, lengths, owner = [], [], [], []
    question, answer = [], []
    for i in range(len(ids)):
        q, a = q_words[q_at[i] : q_at[i + 1]], a_words[a_at[i] : a_at[i + 1]]
        for words in pieces(np.concatenate([q, a])):
            terms, counts = np.unique(words, return_counts=True)
            terms_of.append(terms)
            counts_of.append(counts)
            lengths.append(len(words))
            owner.append(i)
        for words, kept, least in ((q, question, 0), (a, answer, LEAST_RUN_ANSWER)):
            size = 1 if len(words) < least else max(1, min(RUN, len(words)))
            kept.append((size, runs(words, size)))
    code = np.concatenate([np.zeros(0, np.uint64), *terms_of])
    count = np.concatenate([np.zeros(0), *counts_of])
    n = len(owner)
    piece = np.repeat(np.arange(n), [len(t) for t in terms_of])
    terms, number, seen = np.unique(code, return_inverse=True, return_counts=True)
    if frequency is not None:
        seen = np.array([frequency[int(t)] for t in terms.view(np.int64)])
    idf = np.log(1 + (n_pieces - seen + 0.5) / (seen + 0.5))
    long = np.array(lengths, float)[piece] / max(mean_words, 1)
    weights = idf[number] * count * (K1 + 1) / (count + K1 * (1 - B + B * long))
    own = np.bincount(piece, weights=weights, minlength=n)
    weights = weights / own[piece]
    # The commonest terms of a piece, up to REST of its score, are not searched.
    order = np.lexsort((number, -seen[number], piece))
    number, piece, weights = number[order], piece[order], weights[order]
    bounds = np.searchsorted(piece, np.arange(n + 1))
    running = np.cumsum(weights)
    running -= np.concatenate([[0.0], running])[bounds[:-1]][piece]
    searched = running > REST
    rest = np.bincount(piece[~searched], weights=weights[~searched], minlength=n)
    n_blocks = -(-n // BLOCK)
    block_rest = np.zeros(n_blocks)
    np.maximum.at(block_rest, np.arange(n) // BLOCK, rest)
    cell = number[searched] * n_blocks + piece[searched] // BLOCK
    cells, place = np.unique(cell, return_inverse=True)
    block_most = np.zeros(len(cells))
    np.maximum.at(block_most, place, weights[searched])
    cell_term, cell_block = np.divmod(cells, max(n_blocks, 1))
    spans = list(zip(bounds[:-1], bounds[1:]))
    return ItemIndex(
        np.array(ids, np.int64), np.array(owner, np.int64), np.bincount(np.array(owner, np.int64), weights=lengths, minlength=len(ids)).astype(np.int64),
        terms, np.searchsorted(cell_term, np.arange(len(terms) + 1)), cell_block, block_most, LEAST_SCORE - block_rest,
        [number[a:b] for a, b in spans], [weights[a:b] for a, b in spans], question, answer,
    )


def _span(begin: int, stop: int, length: int, first: int, last: int) -> tuple[int, int]:
    """The part of a text (words ``first`` to ``last``) an item is verified over, around a passage.

    It reaches a passage, or an item that is longer, to both sides. For long items it
    starts and ends at multiples of a power of two, so that passages share it and
    verifying takes time linear in the text.
    """
    if length <= PASSAGE:
        return max(first, begin - PASSAGE), min(last, stop + PASSAGE)
    unit = 1 << (length - 1).bit_length()
    return max(first, first + ((begin - first) // unit - 1) * unit), min(last, first + ((stop - first) // unit + 2) * unit)


def matches(index: ItemIndex, texts: pa.Array) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share) of the verified items, best passage each."""
    if not len(index.terms):
        return []
    words, at = _words(texts)
    term = index.lookup(words)
    counts = np.diff(at)
    windows = np.maximum(1, -(-(counts - PASSAGE + STRIDE) // STRIDE)) * (counts > 0)
    owner = np.repeat(np.arange(len(counts)), windows)
    first_window = np.cumsum(windows) - windows
    begin = at[owner] + (np.arange(len(owner)) - first_window[owner]) * STRIDE
    stop = np.minimum(begin + PASSAGE, at[owner + 1])
    # Every searched word belongs to a few passages; a term counts once in each.
    place = np.flatnonzero(term >= 0)
    place = place[index.first[term[place] + 1] > index.first[term[place]]]
    text_of = np.searchsorted(at, place, side="right") - 1
    local = place - at[text_of]
    pairs = []
    for back in range(-(-PASSAGE // STRIDE)):
        window = local // STRIDE - back
        inside = (window >= 0) & (window < windows[text_of]) & (local < window * STRIDE + PASSAGE)
        pairs.append((first_window[text_of] + window)[inside] * len(index.terms) + term[place][inside])
    passages, terms = np.divmod(np.unique(np.concatenate(pairs)), len(index.terms))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    known: dict[tuple[int, int, int], tuple[float, ...]] = {}
    last_text = -1
    for w, block in zip(*(x.tolist() for x in index.open_blocks(passages, terms))):
        seen = term[begin[w] : stop[w]]
        retrieved = index.retrieve(block, seen[seen >= 0])
        if not retrieved:
            continue
        text = int(owner[w])
        if text != last_text:
            known.clear()
            last_text = text
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for piece, score in retrieved:
            item = int(index.owner[piece])
            span = _span(int(begin[w]), int(stop[w]), int(index.lengths[item]), int(at[text]), int(at[text + 1]))
            if (item, *span) not in known:
                shares = []
                for size, own in (index.question[item], index.answer[item]):
                    if (size, *span) not in held:
                        held[size, *span] = runs(words[span[0] : span[1]], size)
                    shares.append(float(np.isin(own, held[size, *span]).mean()) if len(own) else 1.0)
                known[item, *span] = tuple(shares)
            shares = known[item, *span]
            if shares[0] >= LEAST_QUESTION and shares[1] >= LEAST_ANSWER:
                key = (text, item)
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (round(score, 9), *shares))
    return [(text, item, *values) for (text, item), values in sorted(best.items())]


def indexes(items: DataFrame, id_col: str, question_col: str, answer_col: str | None) -> Iterator[Broadcast]:
    """The items' index in parts of a checked size, each broadcast.

    Rows without an id, or without a word, are left out. With no answer column
    the question is the whole item.
    """
    spark = items.sparkSession
    ship(spark)
    rows = items.select(
        items[id_col].cast("bigint").alias("item_id"), F.coalesce(items[question_col].cast("string"), F.lit("")).alias("question"),
        (F.lit("") if answer_col is None else F.coalesce(items[answer_col].cast("string"), F.lit(""))).alias("answer"),
    ).where("item_id IS NOT NULL").withColumn("size", F.octet_length("question") + F.octet_length("answer")).where("size > 0")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.int64()), ("words", pa.int64())])
        for batch in slices(batches, "question"):
            both = pa.array([f"{q} {a}" for q, a in zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist())], pa.string())
            words, at = _words(both)
            for a, b in zip(at[:-1], at[1:]):
                for piece in pieces(words[a:b]):  # a row without a term counts the piece and its words
                    terms = np.unique(piece).view(np.int64)
                    yield batch_of(schema, [None, *terms.tolist()], np.append(len(piece), np.zeros(len(terms), np.int64)))

    rows = saved(rows, "test-items")
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return
    parts = max(1, -(-total // PART_BYTES))
    counted = saved(
        rows.select("question", "answer").mapInArrow(split, "term bigint, words bigint")
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")), "test-terms",
    )
    n_pieces, words = counted.where("term IS NULL").select("n", "words").first()
    mean_words = words / n_pieces
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id", "question", "answer").collect()
        if parts == 1:
            known = {r["term"]: r["n"] for r in counted.select("term", "n").collect()}
        else:  # only this part's terms reach the driver
            terms = np.unique(np.concatenate([_words(pa.array([r["question"] + " " + r["answer"] for r in own], pa.string()))[0], np.zeros(0, np.uint64)]))
            wanted = spark.createDataFrame([(t,) for t in terms.view(np.int64).tolist()], "term bigint")
            known = {r["term"]: r["n"] for r in counted.join(wanted, "term").collect()}
        index = build_index([r["item_id"] for r in own], [r["question"] for r in own], [r["answer"] for r in own], n_pieces, mean_words, known)
        yield spark.sparkContext.broadcast(index)


def find_contamination(
    docs: DataFrame, items: DataFrame, item_col: str = "item_id", question_col: str = "question", answer_col: str | None = "answer",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share: the items each text holds.

    One row per input row and item that is verified; texts that are null, empty or clean have
    none. Repeated rows are reported each, repeated items once per row. ``score`` is that of
    the best passage against a piece of the item, and shares are those around that passage.
    Items without answers of their own: give the whole text as ``question_col`` and None as
    ``answer_col``; question_share is then that of the whole item and answer_share 1. With no items there is no row.
    """
    found = docs.sparkSession.createDataFrame([], FOUND_SQL)
    for shared in indexes(items, item_col, question_col, answer_col):

        def search(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                got = matches(shared.value, batch.column("text"))
                if got:
                    text, item, score, question, answer = zip(*got)
                    yield batch_of(FOUND, batch.column("doc_id").take(pa.array(text)), shared.value.items[list(item)], score, question, answer)

        found = found.unionByName(documents(docs, id_col, text_col).mapInArrow(search, FOUND_SQL))
    return found


def keep_clean(
    docs: DataFrame, items: DataFrame, item_col: str = "item_id", question_col: str = "question", answer_col: str | None = "answer", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with their columns; no join, no shuffle.

    Items as for find_contamination.
    """
    names = [f"_own_{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    kept = docs.toDF(*names)
    for shared in indexes(items, item_col, question_col, answer_col):

        def clean(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                mask = np.ones(batch.num_rows, bool)
                mask[[m[0] for m in matches(shared.value, batch.column(text))]] = False
                yield batch.filter(pa.array(mask))

        kept = kept.mapInArrow(clean, kept.schema)
    return kept.toDF(*docs.columns)
