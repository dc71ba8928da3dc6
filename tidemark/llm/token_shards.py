"""Token ids of a corpus as shards, each a wavelet matrix in one compressed file.

Documents are dealt by ranges of ``doc_id``; a task encodes its range and writes
rows of (shard, ids of its documents, their token counts, packed matrix). A
shard's number is its task's place in the range order, then its place in the
task, so shards sort as the documents do.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import batch_of, documents, release, ship, slices
from tidemark.llm.wavelet import WaveletMatrix

# Encoded chunks, and words within them, that a worker keeps before it starts over.
KEPT_CHUNKS = 600_000
KEPT_WORDS = 900_000
KEPT_LENGTH = 64
# A shard is closed once it has this many tokens; a document is never cut.
SHARD_TOKENS = 500_000

FILES = "shard bigint, n_docs bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, matrix binary"
FILES_ARROW = pa.schema([
    ("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("matrix", pa.binary()),
])
READ_ARROW = pa.schema([
    ("shard", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64()),
])
# The tokenizer drops blanks and no special token holds one, so what stands
# between blanks is encoded alike alone and in its text.
BLANKS = re.compile(r"[ \t\n\r\x0b\x0c]+")
# What str.split takes for blanks beyond those.
ODD_BLANKS = "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# A word and the marks behind it are separate pieces to the tokenizer, whatever
# the word's case. Apostrophes, and what special tokens are made of, are no marks here.
MARKS = "-!\"#$%&()*+,./:;=?@[\\]^_`{}~"
# Texts on which the encoder must agree with the library: a file of another kind is refused.
PROBES = (
    "Hello, World! Hello WORLD... it's (a) test-case: 3.14 & more; they'll e-mail café, ÉCOLE straße?",
    "x  y\tz\u00a0w <|endoftext|> naïve--naïve 日本語 😀 'quoted' O'Neil's ABC123def",
)


def chunks_of(text: str | None) -> list[str]:
    if not text:
        return []
    if any(c in text for c in (ODD_BLANKS[:4] if text.isascii() else ODD_BLANKS)):
        return [c for c in BLANKS.split(text) if c]
    return text.split()


class ChunkEncoder:
    """Ids of the chunks between blanks, each word encoded once by the library."""

    def __init__(self, path: str, kept_share: float = 1.0):
        import tokenizers

        self.kept_share = kept_share
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # The tokens that end a word.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = np.dtype("<u2" if len(self.ends) <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        for probe in PROBES:
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            if self.encode([probe], 0)[0].tolist() != [*whole, 0]:
                raise ValueError(f"{path} does not tell pieces apart as this encoder does")

    def encode(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        split = [chunks_of(t) for t in texts]
        if len(self.known) > KEPT_CHUNKS * self.kept_share:
            self.known = {}
        if len(self.words) > KEPT_WORDS * self.kept_share:
            self.words = {}
        known = self.known
        found = [list(map(known.get, chunks)) for chunks in split]
        fresh: set[str] = set()
        gaps: list[list[int]] = []
        for chunks, parts in zip(split, found):
            own = [at for at, part in enumerate(parts) if part is None] if None in parts else []
            fresh.update([chunks[at] for at in own])
            gaps.append(own)
        self._learn(fresh)
        end = np.array([end_id], self.kind).tobytes()
        out = []
        for chunks, parts, own in zip(split, found, gaps):
            for at in own:
                parts[at] = known[chunks[at]]
            parts.append(end)
            out.append(np.frombuffer(b"".join(parts), self.kind))
        for chunk in fresh:
            if len(chunk) > KEPT_LENGTH:
                del known[chunk]
        return out

    def _learn(self, fresh: set[str]) -> None:
        known, words = self.known, self.words
        plain: list[str] = []
        lowered: list[str] = []
        other: list[str] = []
        missing: set[str] = set()
        for chunk in fresh:
            word = chunk.rstrip(MARKS)
            if word.isalpha() and len(chunk) <= KEPT_LENGTH and (word.isascii() or max(word) <= "ÿ"):
                low = word.lower()
                if low not in words:
                    missing.add(low)
                if len(word) < len(chunk) and (marks := chunk[len(word) :]) not in words:
                    missing.add(marks)
                plain.append(chunk)
                lowered.append(low)
            else:
                other.append(chunk)
        # A lower-case ASCII word is what the tokenizer hands to its model.
        plainest = [w for w in missing if w.isascii() and w.isalpha()]
        if plainest:
            flat: list[int] = []
            cuts = [0]
            for word in plainest:
                flat += [t.id for t in self.model.tokenize(word)]
                cuts.append(len(flat))
            ids = np.array(flat, self.kind).tobytes()
            size = self.kind.itemsize
            words.update(zip(plainest, [ids[a * size : b * size] for a, b in zip(cuts, cuts[1:])]))
            missing.difference_update(plainest)
        # Of the others, one text of words between blanks is one piece per word.
        if missing:
            joined = np.array(self.tokenizer.encode_batch_fast([" ".join(missing)], add_special_tokens=False)[0].ids, self.kind)
            stops = ((np.flatnonzero(self.ends[joined]) + 1) * self.kind.itemsize).tolist()
            if len(stops) != len(missing):
                raise ValueError("the tokenizer does not mark the ends of words")
            ids, start = joined.tobytes(), 0
            for word, stop in zip(missing, stops):
                words[word] = ids[start:stop]
                start = stop
        for chunk, low in zip(plain, lowered):
            size = len(low)
            known[chunk] = words[low] if len(chunk) == size else words[low] + words[chunk[size:]]
        for chunk, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            known[chunk] = np.array(got.ids, self.kind).tobytes()


_encoders: dict[tuple[str, float], ChunkEncoder] = {}


def encoder(path: str, kept_share: float = 1.0) -> ChunkEncoder:
    key = path, kept_share
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, kept_share)
    return _encoders[key]


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    kept_share: float = 1.0,
) -> None:
    """Encode every whole text, append ``end_id`` and write the shards below ``path``.

    A null or empty text is its end id alone. Rows with a null id come first,
    rows of one id in the order of their texts' hashes; each row is a document
    of its own. An empty table writes no shard. ``kept_share`` scales what a
    worker remembers, and below 1 it forgets it after each task; less takes less memory and more time, with the same ids.
    """
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, kept_share)
        task, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in slices(batches):
            tokens = enc.encode(batch.column("text").to_pylist(), end_id)
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), tokens):
                ids.append(doc_id)
                parts.append(own)
                held += len(own)
                if held >= shard_tokens:
                    yield _shard(task << 24 | number, ids, parts)
                    ids, parts, held, number = [], [], 0, number + 1
        if ids:
            yield _shard(task << 24 | number, ids, parts)
        if kept_share < 1:
            enc.known, enc.words = {}, {}
            release()

    base = documents(docs, id_col, text_col)
    # Rows without an id may be many; their texts tell them apart.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    base.repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(encode, FILES).write.option(
        "compression", "zstd"
    ).mode("overwrite").parquet(path)


def _shard(shard: int, ids: list[int | None], parts: list[np.ndarray]) -> pa.RecordBatch:
    lengths = [len(p) for p in parts]
    matrix = WaveletMatrix.build(np.concatenate(parts)).to_bytes()
    return batch_of(FILES_ARROW, [shard], [len(ids)], [sum(lengths)], [ids], [lengths], [matrix])


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, first: tokens before each shard. One row per shard, no matrix read."""
    shards = spark.read.parquet(path).select("shard", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard: one row per document, from the files.

    ``start`` counts the tokens of all documents before it; ``ids_crc32`` is over
    the ids as little-endian unsigned 32-bit integers, the end id included.
    """
    ship(spark)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = WaveletMatrix.from_bytes(batch.column("matrix")[i].as_buffer()).decode()
                lengths = batch.column("doc_tokens")[i].values.to_numpy()
                stops = np.cumsum(lengths)
                starts = stops - lengths
                crcs = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(starts, stops)]
                n = len(lengths)
                shard = np.full(n, batch.column("shard")[i].as_py())
                yield batch_of(READ_ARROW, shard, np.arange(n), batch.column("doc_ids")[i].values, lengths, crcs, starts)

    rows = spark.read.schema(FILES).parquet(path).select("shard", "doc_ids", "doc_tokens", "matrix").mapInArrow(
        decode, "shard bigint, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, offset bigint"
    )
    return rows.join(shard_starts(spark, path), "shard").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "place"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids: the token ids themselves, one row per document."""
    ship(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = WaveletMatrix.from_bytes(batch.column("matrix")[i].as_buffer()).decode().astype(np.int64)
                stops = np.concatenate([[0], np.cumsum(batch.column("doc_tokens")[i].values.to_numpy())]).astype(np.int32)
                yield batch_of(schema, batch.column("doc_ids")[i].values, pa.ListArray.from_arrays(stops, tokens))

    return spark.read.schema(FILES).parquet(path).mapInArrow(decode, "doc_id bigint, ids array<bigint>")


def token_occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """position (in the whole corpus) of every occurrence of a token, by select.

    A task holds one shard's matrix; positions leave it in small batches.
    """
    ship(spark)
    schema = pa.schema([("shard", pa.int64()), ("place", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("matrix")[i].as_buffer())
                places = [matrix.select(token, k) for k in range(matrix.count(token))]
                yield batch_of(schema, [batch.column("shard")[i].as_py()] * len(places), places)

    found = spark.read.schema(FILES).parquet(path).select("shard", "matrix").mapInArrow(find, "shard bigint, place bigint")
    return found.join(shard_starts(spark, path), "shard").select((F.col("first") + F.col("place")).alias("position"))
