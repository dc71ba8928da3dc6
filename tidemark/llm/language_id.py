"""Language ID by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows, each is
max-pooled over its window, and a softmax layer reads the pooled values. The
network is trained in numpy on a bounded, hashed sample of labelled texts. A
text of any length is cut into windows without gaps; their scores are averaged
by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import batch_of, documents, fold, ship, utf8, slices

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# Labelled texts per language that the network is trained on, at most about.
SAMPLE = 500
# Windows of each sampled text that are seen in training.
SAMPLE_WINDOWS = 4
EPOCHS = 8
UNKNOWN = "und"

PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lowered, and the upper-case letters of the Latin-1 block."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    low = table[data]
    second = np.zeros(len(low), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[second] += 32
    return low


def windows_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of WINDOW lowered bytes, the text each is from); the last is padded with 0."""
    sizes = np.diff(ends)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    within = (np.arange(len(owner)) - first[owner]) * WINDOW
    padded = np.concatenate([_lower(data), np.zeros(WINDOW, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[ends[:-1][owner] + within].copy()
    left = sizes[owner] - within
    short = left < WINDOW
    rows[short] *= np.arange(WINDOW) < left[short][:, None]
    return rows, owner


@dataclass
class ByteNet:
    """The network; ``tables`` holds each filter's response to a byte at each of its places."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    tables: list[list[np.ndarray]] = field(default_factory=list)

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteNet:
        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        embedding = rng.normal(0, 1, (256, EMBEDDING)).astype(np.float32)
        embedding[0] = 0
        return cls(
            languages, embedding, [normal(w * EMBEDDING, FILTERS) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            normal(FILTERS * len(WIDTHS), len(languages)), np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.out, self.out_bias]

    def freeze(self) -> None:
        """Fold the embedding into the filters: pairs of bytes where a filter has two places."""
        self.tables = []
        for width, weights in zip(WIDTHS, self.filters):
            places = [self.embedding @ weights[i * EMBEDDING : (i + 1) * EMBEDDING] for i in range(width)]
            joined = [(places[i][:, None] + places[i + 1][None]).reshape(65536, FILTERS) for i in range(0, width - 1, 2)]
            self.tables.append([np.ascontiguousarray(t, np.float32) for t in joined + places[2 * len(joined) :]])

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """One row of language scores per window."""
        pairs = rows[:, :-1].astype(np.uint16) << 8 | rows[:, 1:]
        pooled = []
        for width, tables, bias in zip(WIDTHS, self.tables, self.biases):
            n = WINDOW - width + 1
            answer = np.take(tables[0], pairs[:, :n], axis=0)
            for place, table in enumerate(tables[1:], 1):
                at = 2 * place
                answer += np.take(table, (pairs if len(table) > 256 else rows)[:, at : at + n], axis=0)
            pooled.append(np.maximum(answer.max(axis=1) + bias, 0))
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 5) -> ByteNet:
    """Fit by Adam on cross entropy; a share of the windows is shortened, as short texts are."""
    rng = np.random.default_rng(seed)
    net = ByteNet.fresh(languages, rng)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs if len(languages) > 1 else 0):
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            batch = rows[chosen].copy()
            keep = np.where(rng.random(len(batch)) < 0.3, rng.integers(8, WINDOW, len(batch)), WINDOW)
            batch *= np.arange(WINDOW) < keep[:, None]
            step += 1
            for p, g, (m, v) in zip(net.parameters(), _gradients(net, batch, labels[chosen]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embedding[0] = 0
    net.freeze()
    return net


def _gradients(net: ByteNet, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    n = len(rows)
    embedded = net.embedding[rows].reshape(n, -1)
    pooled, winners = [], []
    for width, weights, bias in zip(WIDTHS, net.filters, net.biases):
        spans = np.lib.stride_tricks.sliding_window_view(embedded, width * EMBEDDING, axis=1)[:, ::EMBEDDING]
        answer = spans @ weights + bias
        winners.append(answer.argmax(axis=1))
        pooled.append(answer.max(axis=1))
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    scores = hidden @ net.out + net.out_bias
    chance = np.exp(scores - scores.max(axis=1, keepdims=True))
    chance /= chance.sum(axis=1, keepdims=True)
    chance[np.arange(n), labels] -= 1
    chance /= n
    back = (chance @ net.out.T) * (raw > 0)
    filters, biases, embedding = [], [], np.zeros_like(net.embedding)
    for k, (width, weights) in enumerate(zip(WIDTHS, net.filters)):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        at = winners[k][:, :, None] + np.arange(width)
        bytes_seen = rows[np.arange(n)[:, None, None], at]
        inputs = net.embedding[bytes_seen].reshape(n, FILTERS, width * EMBEDDING)
        filters.append(np.einsum("nf,nfd->df", own, inputs))
        biases.append(own.sum(axis=0))
        to_input = (own[:, :, None] * weights.T[None]).reshape(-1, EMBEDDING)
        np.add.at(embedding, bytes_seen.reshape(-1), to_input)
    return [embedding, *filters, *biases, hidden.T @ chance, chance.sum(axis=0)]


def training_texts(rows: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """(lang, text) of about ``sample`` rows per language, chosen by a hash of their ids.

    Two scans: rows per language, then the rows whose hash is below their
    language's share; what reaches the driver is ``sample`` excerpts a language.
    """
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    chance = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])
    # An excerpt long enough for the windows a text gives, from a hashed place.
    length = WINDOW * SAMPLE_WINDOWS
    start = 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - length, F.lit(0)) + 1).cast("int")
    picked = rows.where(chance < shares[F.col("lang")]).select("lang", F.substring("text", start, F.lit(length)).alias("text"), "doc_id")
    return [(r["lang"], r["text"]) for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"]))]


def fit(rows: DataFrame, sample: int = SAMPLE) -> ByteNet:
    """A network learned from rows of (doc_id, text, lang)."""
    texts = training_texts(rows.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''"), sample)
    languages = sorted({lang for lang, _ in texts})
    data, ends = utf8(pa.array([t for _, t in texts], pa.string()))
    windows, owner = windows_of(data, ends)
    labels = np.array([languages.index(lang) for lang, _ in texts], np.int64)[owner] if texts else np.zeros(0, np.int64)
    return train(windows, labels, languages)


def classify(net: ByteNet, values: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of every whole text."""
    data, ends = utf8(values)
    n = len(values)
    known = len(net.languages)
    totals, weight = np.zeros((n, max(known, 1))), np.zeros(n)
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    first = 0
    while first < n:  # groups of texts of about a megabyte
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + (1 << 20), side="right")) - 1)
        rows, owner = windows_of(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        for at in range(0, len(rows), 256):
            some, own = rows[at : at + 256], owner[at : at + 256] + first
            letters = letter[some].sum(axis=1)
            if known:
                np.add.at(totals, own, net.logits(some) * letters[:, None])
            np.add.at(weight, own, letters)
        first = last
    mean = totals / np.maximum(weight, 1)[:, None]
    chance = np.exp(mean - mean.max(axis=1, keepdims=True))
    chance /= chance.sum(axis=1, keepdims=True)
    best = chance.argmax(axis=1)
    texts = values.to_pylist()
    lettered = [known > 0 and w > 0 and any(map(str.isalpha, t)) for w, t in zip(weight, texts)]
    return (
        [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
        [float(chance[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered))],
    )


def predict(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per input row.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing was learned. The network (about 10 MB) is broadcast.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = classify(shared.value, batch.column("text"))
            yield batch_of(PREDICTED, batch.column("doc_id"), langs, scores)

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Whether a row is kept from training; a row without an id is."""
    return F.coalesce(fold(id_col, parts) == part, F.lit(True))


def identify_languages(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows not held out."""
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")
    )
    net = fit(rows.where(~held_out()), sample)
    return predict(rows, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
