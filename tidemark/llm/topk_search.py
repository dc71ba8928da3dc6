"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors stand in blocks. A block's index has, per dimension, the vectors by
quantised level; a level's vectors are a posting segment whose impact on a query
is |query component| times the level's height above the lowest. A query's
segments are processed by falling impact into accumulators. What is unprocessed
bounds what any vector may still gain, so processing stops once few vectors can
be among the k best; those are rescored exactly. Quantisation is part of the
bound, so no vector is lost.

A task holds some blocks and lets all queries pass by them, so queries are
copied once per task, not once per block, and what a query has found in one
block bounds what it looks for in the next.
"""

from __future__ import annotations

import io
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import batch_of, saved, ship

SCALE = 1024
LEVELS = 16
BLOCK = 8192
QUERY_BLOCK = 256
# Processing may stop when this share of a block is left to rescore.
RESCORED = 1 / 16
ROUNDS = 8
# Bytes of index blocks that a task holds, or one block.
HELD_BYTES = 64 << 20

BLOCKS = pa.schema([("number", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])
HITS = pa.schema([("query_id", pa.int64()), ("mark", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def grid(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their components floor(SCALE * x)), shorter vectors padded with 0."""
    lengths = np.array([0 if n is None else n for n in values.value_lengths().to_pylist()], np.int64)
    flat = values.flatten()
    gaps = np.asarray(flat.is_null()) if flat.null_count else np.zeros(len(flat), bool)
    x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.zeros(len(lengths), bool)
    bad[owner[gaps | ~np.isfinite(x)]] = True
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width))
    place = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, place] = x
    rows = np.flatnonzero((lengths > 0) & ~bad)
    scaled = np.floor(SCALE * out[rows])
    if (np.abs(scaled) >= 2.0**62).any():
        raise OverflowError("a component does not fit 64 bits")
    return rows, scaled.astype(np.int64)


class ImpactIndex:
    """Posting segments of one block of vectors.

    ``postings`` has per dimension the vectors by level, ``starts`` where each
    level begins; level ``v`` holds components from ``low + v * step`` on.
    """

    FIELDS = ("ids", "vectors", "low", "step", "postings", "starts")

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, step: np.ndarray, postings: np.ndarray, starts: np.ndarray):
        self.ids, self.vectors, self.low, self.step, self.postings, self.starts = ids, vectors, low, step, postings, starts
        self.most = float(np.abs(vectors.astype(float)).max(initial=0))

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> ImpactIndex:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        low = vectors.min(axis=0)
        step = np.maximum(1, -(-(vectors.max(axis=0) - low + 1) // LEVELS))
        level = (vectors - low) // step
        postings = np.argsort(level, axis=0, kind="stable").T.astype(np.uint16 if len(ids) <= 65536 else np.uint32, order="C")
        starts = np.stack([np.searchsorted(np.sort(column), np.arange(LEVELS + 1)) for column in level.T])
        return cls(ids, narrow(vectors), low, step, postings, starts)

    @property
    def size(self) -> int:
        return sum(getattr(self, f).nbytes for f in self.FIELDS)

    def top(self, query: np.ndarray, own: int, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to the smaller id, rows of id ``own`` left out.

        Vectors that score less than ``floor`` may be missing.
        """
        n, dims = self.vectors.shape
        size = max(dims, len(query))
        query = np.pad(query, (0, size - len(query)))[:dims]
        others = self.ids != own
        if (self.most + LEVELS) * float(np.abs(query.astype(float)).sum()) >= 2**48:
            return self._best(others, query, k)  # sums of bounds would not be exact
        weight = np.abs(query) * self.step
        # The level counted from the side where the component's product is lowest.
        height = np.where(query[:, None] > 0, np.arange(LEVELS), np.arange(LEVELS - 1, -1, -1))
        impact = weight[:, None] * height
        filled = (np.diff(self.starts, axis=1) > 0) & (impact > 0)
        dim, level = np.nonzero(filled)
        order = np.argsort(-impact[dim, level], kind="stable")
        dim, level = dim[order], level[order]
        gain = impact[dim, level].astype(float)
        starts, stops = self.starts[dim, level], self.starts[dim, level + 1]
        lengths, spans = stops - starts, list(zip((dim * n + starts).tolist(), (dim * n + stops).tolist()))
        postings = self.postings.reshape(-1)
        error = int((np.abs(query) * (self.step - 1)).sum())
        lowest = int((query * np.where(query > 0, self.low, self.low + LEVELS * self.step - 1)).sum())
        wanted = -math.inf if floor is None else floor - lowest
        gained = np.zeros(n)
        left = others
        for r in range(ROUNDS):
            at, stop = len(dim) * r // ROUNDS, len(dim) * (r + 1) // ROUNDS
            if at < stop:
                found = np.concatenate([postings[a:b] for a, b in spans[at:stop]], dtype=np.intp)
                gained += np.bincount(found, weights=np.repeat(gain[at:stop], lengths[at:stop]), minlength=n)
            still = np.zeros(dims)  # what each component may still add: the first that is left, as the last to be set
            still[dim[stop:][::-1]] = gain[stop:][::-1]
            reach = still.sum() + error
            scores = gained[others]
            least = wanted if len(scores) <= k else max(wanted, np.partition(scores, len(scores) - k)[len(scores) - k])
            left = others & (gained + reach >= least)
            if left.sum() <= max(4 * k, RESCORED * n):
                break
        return self._best(left, query, k)

    def _best(self, left: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(left)
        exact = inner(self.vectors[rows], query, self.most * float(np.abs(query.astype(float)).sum()))
        return best_of(self.ids[rows], exact, k)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def inner(vectors: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products, none larger than ``most``; floating multiplication where it is exact. A product beyond 64 bits is an error."""
    if most < 2**52:
        return (vectors.astype(float) @ query.astype(float)).astype(np.int64)
    if most < 2**62:
        return vectors @ query
    exact = [sum(int(x) * int(y) for x, y in zip(row, query)) for row in vectors]
    if any(not -(1 << 63) <= x < 1 << 63 for x in exact):
        raise OverflowError("an inner product does not fit 64 bits")
    return np.array(exact, np.int64)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes each as hold them all."""
    least, most = values.min(initial=0), values.max(initial=0)
    return values.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


def _to_bytes(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _packed(rows: DataFrame, size: int, index: bool) -> DataFrame:
    """Rows of (vec_id, embedding) as numbered blocks of at most ``size`` vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            width = max(v.shape[1] for v in vectors)
            block = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in vectors])
            own = np.concatenate(ids)
            if index:
                built = ImpactIndex.build(own, block)
                taken, data = built.size, _to_bytes(**{f: getattr(built, f) for f in ImpactIndex.FIELDS})
            else:
                taken, data = block.nbytes, _to_bytes(ids=own, vectors=narrow(block))
            return batch_of(BLOCKS, [(task << 32) + made], [taken], [data])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                some = batch.slice(at, size)
                used, block = grid(some.column("embedding"))
                if not len(used):
                    continue
                if held and held + len(used) > size:
                    yield flush()
                    ids, vectors, held, made = [], [], 0, made + 1
                ids.append(some.column("vec_id").to_numpy()[used])
                vectors.append(block)
                held += len(used)
        if held:
            yield flush()

    return rows.mapInArrow(pack, "number bigint, size bigint, data binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query.

    Components are floor(1024 x) of x as double. Vectors that are null, empty or
    hold a null or non-finite component take no part, nor do rows without an
    id; missing trailing components count as 0. A query's own are the rows of
    its id. Repeated rows are candidates each; a repeated query is answered
    once. Every query block meets every index block once, and a task returns
    k rows per query, of all its index blocks.
    """
    spark = vectors.sparkSession
    ship(spark)

    def base(df: DataFrame) -> DataFrame:
        return df.select(df[id_col].cast("bigint").alias("vec_id"), df[vector_col].cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL")

    index = saved(_packed(base(vectors), BLOCK, True), "impact-index")
    asked = saved(_packed(base(queries).dropDuplicates(["vec_id", "embedding"]).coalesce(8), QUERY_BLOCK, False), "impact-queries")
    blocks, size = index.agg(F.count("number"), F.sum("size")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = max(1, min(blocks, max(tasks, -(-(size or 0) // HELD_BYTES))))
    # Blocks are dealt evenly: place by place, a number per block.
    dealt = index.select("number", F.floor((F.row_number().over(Window.orderBy("number")) - 1) * places / max(1, blocks)).cast("int").alias("place"))
    placed = index.join(F.broadcast(dealt), "number").select("place", F.lit(False).alias("asked"), "data")
    # Queries are moved by a shuffle: Spark takes them for no more than their file, however often they are copied, and would broadcast that.
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("place"), F.lit(True).alias("asked"), "data")
    met = placed.unionByName(sent).repartitionById(places, "place").sortWithinPartitions("asked").select("asked", "data")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[ImpactIndex] = []
        for batch in batches:
            for i in range(batch.num_rows):
                with np.load(io.BytesIO(batch.column("data")[i].as_py())) as data:
                    if not batch.column("asked")[i].as_py():
                        held.append(ImpactIndex(*[data[f] for f in ImpactIndex.FIELDS]))
                        continue
                    owns, queries = data["ids"].tolist(), data["vectors"].astype(np.int64)
                best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(owns)
                for block in held:
                    for q, (own, query) in enumerate(zip(owns, queries)):
                        ids, scores = best[q]
                        found = block.top(query, own, k, int(scores[-1]) if 0 < k == len(scores) else None)
                        best[q] = best_of(np.concatenate([ids, found[0]]), np.concatenate([scores, found[1]]), k)
                counts = [len(ids) for ids, _ in best]
                marks = [zlib.crc32(query.tobytes()) for query in queries]  # tell apart different vectors of one id
                yield batch_of(HITS, np.repeat(owns, counts), np.repeat(marks, counts), *(np.concatenate(x) for x in zip(*best)))

    hits = met.mapInArrow(search, "query_id bigint, mark bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS g
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(g) AS y, unnest(range(len(g))) AS place FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.y * c.y) AS BIGINT) AS score
      FROM c AS q JOIN c ON q.place = c.place AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
