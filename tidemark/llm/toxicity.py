"""Toxicity by the nearest labelled examples, found by exact TF-IDF cosine.

Terms are stretches of 5 and of 8 bytes of the lowered text, so that a family of
words shares terms whatever its endings. Of a bounded, hashed sample of labelled
texts all terms are kept that mark the toxic class beyond chance; examples and texts
are TF-IDF vectors over them, and a text that has any of them is compared. The examples stand in an inverted index whose
postings are cut into blocks of neighbouring examples with the largest weight of
every term: blocks are visited by falling bound until no bound reaches the
k-th best cosine, so the neighbours are exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import batch_of, documents, fold, release, ship, slices, utf8

# Bytes of a term; a code holds 8.
TERM_BYTES = (5, 8)
# Labelled texts per class, at most about.
SAMPLE = 2000
# Places of a text that are looked at once.
PIECE = 1 << 17
# Least log-likelihood ratio (G squared), document count and share of toxic rows
# among the labelled rows that have a kept term.
LEAST_G2 = 40.0
LEAST_DOCS = 3
LEAST_SHARE = 0.9
NEIGHBOURS = 15
BLOCK = 64
# Votes of cosine 1 that the base rate weighs as much as.
PRIOR_VOTES = 0.5
THRESHOLD = 0.3

SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("neighbours", pa.list_(pa.int64()))])


def spaced_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the lowered texts back to back; the place after each text's last).

    Texts stand apart by blanks and a 0 byte, which no kept term holds.
    """
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    low[9:14] = 32
    n = len(ends) - 1
    shift = np.repeat(3 * np.arange(n) + 1, np.diff(ends))
    spaced = np.full(len(data) + 3 * n + max(TERM_BYTES), 32, np.uint8)
    spaced[ends[1:] + 3 * np.arange(n) + 2] = 0
    spaced[np.arange(len(data)) + shift] = low[data]
    return spaced, ends[1:] + 3 * np.arange(1, n + 1)


def codes_of(spaced: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first place, per term length the code at every place from there), PIECE places at once."""
    longest = max(TERM_BYTES)
    last = len(spaced) - longest
    for at in range(0, last, PIECE):
        places = min(PIECE, last - at)
        codes, out = np.zeros(places, np.uint64), []
        for i in range(longest):
            codes <<= np.uint64(8)
            codes |= spaced[at + i : at + i + places]
            if i + 1 in TERM_BYTES:
                out.append(codes.copy())
        yield at, out


@dataclass
class Model:
    """Vocabulary, index of examples and base rates."""

    terms: np.ndarray
    idf: np.ndarray
    example_ids: np.ndarray
    votes_toxic: np.ndarray
    votes_all: np.ndarray
    postings: np.ndarray
    weights: np.ndarray
    pointers: np.ndarray
    block_max: np.ndarray
    prior: float
    prior_empty: float

    def __post_init__(self) -> None:
        self.slots = np.full(1 << 20, -1, np.int32)
        slot = self._slot(self.terms)
        self.slots[slot] = np.arange(len(self.terms))
        # Terms that share a slot are looked up by search.
        self.crowded = np.zeros(1 << 20, bool)
        own, times = np.unique(slot, return_counts=True)
        self.crowded[own[times > 1]] = True
        self.seen: dict[bytes, tuple[float, list[int]]] = {}

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def vectors(self, data: np.ndarray, ends: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(text, terms, unit weights) of every text that has a kept term."""
        if not len(self.terms):
            return []
        spaced, stops = spaced_of(data, ends)
        places, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at, found in codes_of(spaced):
            for codes in found:
                slot = self._slot(codes)
                term = self.slots[slot]
                hit = np.flatnonzero(term >= 0)
                term = term[hit].astype(np.int64)
                again = np.flatnonzero(self.crowded[slot[hit]])
                term[again] = np.minimum(np.searchsorted(self.terms, codes[hit[again]]), len(self.terms) - 1)
                real = self.terms[term] == codes[hit]
                places.append(hit[real] + at)
                terms.append(term[real])
        owner = np.searchsorted(stops, np.concatenate(places), side="right")
        pairs, counts = np.unique(owner * len(self.terms) + np.concatenate(terms), return_counts=True)
        texts, terms = np.divmod(pairs, len(self.terms))
        weights = (1 + np.log(counts)) * self.idf[terms]
        found, first = np.unique(texts, return_index=True)
        out = []
        for text, a, b in zip(found.tolist(), first, [*first[1:], len(texts)]):
            w = weights[a:b]
            out.append((text, terms[a:b], w / np.sqrt(w @ w)))
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k best, ties to the earlier example."""
        bounds = weights @ self.block_max[terms]
        best = np.zeros(0)
        places = np.zeros(0, np.int64)
        for block in np.argsort(-bounds, kind="stable"):
            least = best[-1] if len(best) == k else 0.0
            if bounds[block] <= 0 or bounds[block] < least - 1e-9:
                break
            scores = np.zeros(BLOCK)
            for term, weight in zip(terms, weights):
                a, b = self.pointers[term, block], self.pointers[term, block + 1]
                scores[self.postings[a:b] % BLOCK] += weight * self.weights[a:b]
            own = np.flatnonzero(scores > 0)
            best = np.concatenate([best, np.round(scores[own], 9)])
            places = np.concatenate([places, own + block * BLOCK])
            order = np.lexsort((places, -best))[:k]
            best, places = best[order], places[order]
        return places, best

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, list[int]]:
        key = terms.tobytes() + weights.tobytes()
        if key not in self.seen:
            if len(self.seen) > 20_000:
                self.seen.clear()
            places, cosines = self.nearest(terms, weights)
            vote = cosines
            toxic, total = vote @ self.votes_toxic[places], vote @ self.votes_all[places]
            # Weights of the sampled classes are scaled to one vote per neighbour.
            scale = vote.sum() / total if total > 0 else 0.0
            chance = (toxic * scale + PRIOR_VOTES * self.prior) / (total * scale + PRIOR_VOTES)
            self.seen[key] = (float(min(max(chance, 0.0), 1.0)), self.example_ids[places].tolist())
        return self.seen[key]


def build(ids: list[int], texts: list[str], toxic: list[int], weight: list[float]) -> Model:
    """A model of labelled texts; ``weight``: labelled rows each stands for."""
    n = len(ids)
    label, share = np.array(toxic, bool), np.array(weight, float)
    codes: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    likely = _likely_slots(texts, label)
    for i, text in enumerate(texts):
        own, times = np.unique(np.concatenate([c[likely[_wide_slot(c)]] for c in _text_codes(text)]), return_counts=True)
        codes.append(own)
        owners.append(np.full(len(own), i))
        counts.append(times)
    code = np.concatenate([np.zeros(0, np.uint64), *codes])
    owner = np.concatenate([np.zeros(0, np.int64), *owners])
    times = np.concatenate([np.zeros(0, np.int64), *counts])
    distinct, place = np.unique(code, return_inverse=True)
    in_toxic = np.bincount(place[label[owner]], minlength=len(distinct)).astype(float)
    in_all = np.bincount(place, minlength=len(distinct)).astype(float)
    stands_for = np.bincount(place, weights=share[owner], minlength=len(distinct))
    toxic_share = np.bincount(place, weights=(share * label)[owner], minlength=len(distinct)) / np.maximum(stands_for, 1e-9)
    kept = _marking(in_toxic, in_all, float(label.sum()), float(n))
    kept = np.sort(kept[toxic_share[kept] >= LEAST_SHARE])
    number = np.full(len(distinct), -1)
    number[kept] = np.arange(len(kept))
    # Document frequency among all labelled rows, not among the evened-out sample.
    total = share.sum()
    frequency = stands_for[kept]
    idf = np.log(1 + total / np.maximum(frequency, 1))
    own = number[place] >= 0
    term, example = number[place[own]], owner[own]
    weights = (1 + np.log(times[own])) * idf[term]
    norms = np.sqrt(np.bincount(example, weights=weights**2, minlength=n))
    weights = weights / norms[example]
    order = np.lexsort((example, term))
    term, example, weights = term[order], example[order], weights[order]
    blocks = -(-n // BLOCK)
    pointers = np.searchsorted(term * blocks + example // BLOCK, np.arange(len(kept) * blocks + 1)) if n else np.zeros(1, np.int64)
    pointers = np.stack([np.append(pointers[t * blocks : (t + 1) * blocks], pointers[(t + 1) * blocks]) for t in range(len(kept))]) if len(kept) else np.zeros((0, blocks + 1), np.int64)
    block_max = np.zeros((len(kept), blocks))
    np.maximum.at(block_max, (term, example // BLOCK), weights)
    empty = np.bincount(example, minlength=n) == 0
    rate = lambda rows: float((share * label)[rows].sum() / share[rows].sum()) if share[rows].sum() else 0.0
    return Model(
        distinct[kept], idf, np.array(ids, np.int64), share * label, share, example, weights, pointers, block_max,
        rate(np.ones(n, bool)), rate(empty),
    )


def _text_codes(text: str) -> Iterator[np.ndarray]:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    for _, codes in codes_of(spaced_of(data, np.array([0, len(data)]))[0]):
        yield from codes


def _wide_slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 24)


def _likely_slots(texts: list[str], label: np.ndarray) -> np.ndarray:
    """Which of 2**24 hashed slots hold terms that may mark the toxic class.

    Slots share counts, so this only spares the exact statistics the many terms
    that are far from marking anything.
    """
    in_toxic, in_all = np.zeros(1 << 24, np.float32), np.zeros(1 << 24, np.float32)
    for text, is_toxic in zip(texts, label):
        slots = np.unique(np.concatenate([np.unique(_wide_slot(c)) for c in _text_codes(text)]))
        in_all[slots] += 1
        if is_toxic:
            in_toxic[slots] += 1
    likely = np.zeros(1 << 24, bool)
    some = np.flatnonzero((in_toxic >= LEAST_DOCS) & (in_toxic > 0.3 * in_all))
    likely[some[_marking(in_toxic[some].astype(float), in_all[some].astype(float), float(label.sum()), float(len(texts)), LEAST_G2 / 4)]] = True
    return likely


def _marking(in_toxic: np.ndarray, in_all: np.ndarray, toxic: float, n: float, least: float = LEAST_G2) -> np.ndarray:
    """Terms by falling G squared of term against toxic label, those that mark the toxic class."""
    if not 0 < toxic < n:
        return np.zeros(0, np.int64)
    g2 = np.zeros(len(in_all))
    for seen, rows, of in (
        (in_toxic, in_all, toxic), (in_all - in_toxic, in_all, n - toxic), (toxic - in_toxic, n - in_all, toxic), (n - toxic - in_all + in_toxic, n - in_all, n - toxic),
    ):
        expected = rows * of / n
        with np.errstate(divide="ignore", invalid="ignore"):
            g2 += np.where(seen > 0, 2 * seen * np.log(seen / expected), 0)
    more = in_toxic / toxic > (in_all - in_toxic) / (n - toxic)
    good = np.flatnonzero((g2 >= least) & (in_all >= LEAST_DOCS) & more)
    return good[np.argsort(-g2[good], kind="stable")]


def sampled_labels(labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """doc_id, toxic, weight: about ``sample`` ids per class by a hash of the id, at most
    4 * sample; weight is the labelled rows each stands for."""
    known = labels.select(labels[id_col].cast("bigint").alias("doc_id"), (labels[label_col] > 0).cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, sample / max(counts.get(1, 1), 1))).otherwise(min(1.0, sample / max(counts.get(0, 1), 1)))
    return known.withColumn("weight", 1 / share).where(chance < share).limit(4 * sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from ``docs`` that ``labels`` names, whatever their length.

    The sample is bounded, so its ids are broadcast and one task learns from its texts; only
    the model reaches the driver. Rows that share an id are one example; null texts are none.
    """
    ship(docs.sparkSession)
    chosen = F.broadcast(sampled_labels(labels, sample))
    rows = documents(docs, id_col, text_col).where("text IS NOT NULL").join(chosen, "doc_id")
    examples = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.max("weight").alias("weight"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic", "weight")]))
        model = pickle.dumps(build(*map(list, zip(*found))) if found else NOTHING)
        del found
        release()
        yield pa.record_batch([pa.array([model], pa.binary())], ["model"])

    learned = examples.repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(learned["model"]) if learned else NOTHING


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, neighbours (ids of the nearest examples): one row per input row.

    A text without a kept term, as an empty or null one, gets the rate of
    toxic examples among such texts; without labels every score is 0.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores, near = scored(shared.value, batch.column("text"))
            yield batch_of(SCORED, batch.column("doc_id"), scores, [int(s >= THRESHOLD) for s in scores], near)

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double, predicted int, neighbours array<bigint>")


def scored(model: Model, values: pa.Array) -> tuple[list[float], list[list[int]]]:
    data, ends = utf8(values)
    scores, near = [model.prior_empty] * len(values), [[] for _ in range(len(values))]
    for text, terms, weights in model.vectors(data, ends):
        scores[text], near[text] = model.score(terms, weights)
    return scores, near


# A model that has seen no example.
NOTHING = build([], [], [], [])


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a row's label is kept from learning; a row without an id has none to learn."""
    return F.coalesce(fold(id_col, parts) == part, F.lit(True))


def detect_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours of every row, learned from the labels not held out."""
    model = fit(docs, labels.where(~held_out()), sample)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "neighbours")


def keep_clean(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns and types.

    Rows pass through the task that scores them: no join by id, no shuffle.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"_own_{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores, _ = scored(shared.value, batch.column(text))
            yield batch.filter(pa.array([s < THRESHOLD for s in scores]))
        shared.value.seen.clear()
        release()

    renamed = docs.toDF(*names)
    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
