"""SimHash near-duplicates by vantage-point trees.

A tree cuts fingerprints by their Hamming distance to vantage points: inside a
radius or outside. Its leaves are shards. What stands on the inner side close to a
cut also visits the outer side (or the other way round, whichever are fewer): by the
triangle inequality no pair within the search radius is then apart, and each
pair meets once. A shard's task goes on cutting in the same way, down to small
leaves that are compared exactly. It keeps a forest, not the pairs: what is
connected already is not compared again, so a dense group of near copies gives
one link per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import batch_of, documents, saved, ship, slices, utf8
from tidemark.llm.components import connected_components

SIZE = 3
RADIUS = 2
SEED = 42
# Words of a text that are hashed at once.
PIECE = 1 << 16
# Fingerprints a shard should own, about; most shards, which bounds the tree that is broadcast.
SHARD = 2048
MOST_SHARDS = 1 << 16
# Sampled fingerprints per shard; they only place the cuts.
SAMPLES = 32
# Fingerprints that are compared one by one, and vantage points tried for a cut.
LEAF = 64
TRIES = 6
# Comparisons held at once.
BLOCK = 1 << 21

PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])
SENT = pa.schema([("shard", pa.int32()), ("print", pa.int64()), ("guest", pa.bool_())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# -- fingerprints ------------------------------------------------------------------


def fingerprint(text: bytes, size: int = SIZE) -> bytes:
    """8 bytes, highest bit first: a bit is 1 if more than half the runs of ``size`` words have it."""
    words = text.lower().split()  # of bytes: A-Z only, and the white space of the contract
    if not words:
        return bytes(8)
    runs = max(len(words) - size + 1, 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, runs, PIECE):
        some = words[at : at + PIECE + size - 1]
        if len(some) < size:
            hashes = digest(b" ".join(some), SEED)
        else:
            hashes = b"".join([digest(b" ".join(run), SEED) for run in zip(*(some[i:] for i in range(size)))])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > runs).tobytes()


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, print (the fingerprint as a signed number) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, ends = utf8(batch.column("text"))
            marks = [fingerprint(data[a:b].tobytes(), size) for a, b in zip(ends[:-1], ends[1:])]
            yield batch_of(PRINTS, batch.column("doc_id"), np.frombuffer(b"".join(marks), ">i8").astype(np.int64))

    return docs.mapInArrow(run, "doc_id bigint, print bigint")


# -- cuts --------------------------------------------------------------------------


def distance(prints: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ vantage)


@dataclass
class Cut:
    """Inside: at most ``radius`` bits from ``vantage``. ``inner``: the inside visits, not the outside."""

    vantage: np.uint64
    radius: int
    inner: bool

    def sides(self, own: np.ndarray, guests: np.ndarray, prints: np.ndarray, reach: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(own, guests) inside and outside, as places in ``prints``."""
        far, visit = distance(prints[own], self.vantage).astype(np.int16), distance(prints[guests], self.vantage).astype(np.int16)
        inside = far <= self.radius
        near_in, near_out = inside & (far > self.radius - reach), ~inside & (far <= self.radius + reach)
        to_in, to_out = guests[visit <= self.radius + reach], guests[visit > self.radius - reach]
        if self.inner:
            to_out = np.concatenate([to_out, own[near_in]])
        else:
            to_in = np.concatenate([to_in, own[near_out]])
        return [(own[inside], to_in), (own[~inside], to_out)]


def best_cut(prints: np.ndarray, reach: int) -> Cut | None:
    """The cut with the fewest visitors among those that leave a quarter on each side;
    else the most even one; None if all are equally far from every vantage tried."""
    best: tuple[tuple[float, float], Cut] | None = None
    n = len(prints)
    for vantage in prints[np.linspace(0, n - 1, min(TRIES, n)).astype(int)]:
        counts = np.bincount(distance(prints, vantage), minlength=65 + reach)
        inside = np.cumsum(counts)
        for radius in range(64):
            if not 0 < inside[radius] < n:
                continue
            lopsided = max(0.0, abs(inside[radius] / n - 0.5) - 0.25)
            outer = inside[min(radius + reach, 64)] - inside[radius]
            inner = inside[radius] - (inside[radius - reach] if radius >= reach else 0)
            rank = (lopsided, min(inner, outer) / n)
            if best is None or rank < best[0]:
                best = rank, Cut(vantage, radius, inner <= outer)
    return best and best[1]


@dataclass
class Tree:
    """Cuts with the two places they lead to: a cut's number, or -1 - shard."""

    cuts: list[Cut]
    ways: list[list[int]]
    shards: int

    def send(self, prints: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, own, guests) as places in ``prints``."""
        ahead = [(0 if self.cuts else -1, np.arange(len(prints)), np.zeros(0, np.int64))]
        while ahead:
            at, own, guests = ahead.pop()
            if not len(own) and not len(guests):
                continue
            if at < 0:
                yield -1 - at, own, guests
                continue
            ahead.extend((way, *side) for way, side in zip(self.ways[at], self.cuts[at].sides(own, guests, prints, reach)))


def grow(sample: np.ndarray, shards: int, reach: int) -> Tree:
    """A tree of about ``shards`` leaves with equal shares of the sample."""
    tree = Tree([], [], 0)
    least = max(len(sample) / max(shards, 1), 2)
    ahead: list[tuple[np.ndarray, int, int]] = [(np.unique(sample), -1, 0)]
    while ahead:
        points, above, side = ahead.pop()
        cut = best_cut(points, reach) if len(points) > 1.5 * least else None
        if cut is None:
            place = -1 - tree.shards
            tree.shards += 1
        else:
            place = len(tree.cuts)
            tree.cuts.append(cut)
            tree.ways.append([0, 0])
            inside = distance(points, cut.vantage) <= cut.radius
            ahead += [(points[inside], place, 0), (points[~inside], place, 1)]
        if above >= 0:
            tree.ways[above][side] = place
    return tree


# -- links -------------------------------------------------------------------------


def _roots(parent: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = parent[places]
    while True:
        up = parent[at]
        if np.array_equal(up, at):
            parent[places] = at
            return at
        at = up


def _unite(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    while len(x):
        x, y = _roots(parent, x), _roots(parent, y)
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def forest(own: np.ndarray, guests: np.ndarray, reach: int = RADIUS) -> np.ndarray:
    """Per fingerprint (own, then guests) the place of its tree's root: own ones are
    compared with each other and with the guests, guests not among themselves."""
    prints = np.concatenate([own, guests])
    parent = np.arange(len(prints))
    ahead = [(np.arange(len(own)), np.arange(len(own), len(prints)))]
    while ahead:
        here, visit = ahead.pop()
        if not len(here):
            continue
        roots = _roots(parent, here)
        if (roots == roots[0]).all():
            # All own ones hang together: only guests that do not may still matter.
            visit = visit[_roots(parent, visit) != roots[0]]
            if not len(visit):
                continue
        cut = best_cut(prints[here[:: -(-len(here) // 256)]], reach) if len(here) > LEAF else None
        if cut is None:
            both = np.concatenate([here, visit])
            step = max(1, BLOCK // len(both))
            for at in range(0, len(here), step):
                near = np.bitwise_count(prints[here[at : at + step], None] ^ prints[both][None, :]) <= reach
                x, y = np.nonzero(near)
                _unite(parent, here[at + x], both[y])
            continue
        # What is near the vantage is near a real fingerprint: link it now.
        middle = here[prints[here] == cut.vantage][:1]
        for some in (here, visit):
            close = some[distance(prints[some], cut.vantage) <= reach]
            _unite(parent, np.full(len(close), middle[0]), close)
        ahead.extend(cut.sides(here, visit, prints, reach))
    return _roots(parent, np.arange(len(prints)))


def routing_tree(prints: DataFrame, n: int, reach: int = RADIUS, shard: int = SHARD) -> Tree:
    """A tree from a hashed sample of the ``n`` distinct fingerprints: SAMPLES a shard, and
    at most MOST_SHARDS shards, so what is collected and broadcast is bounded."""
    shards = min(max(-(-n // shard), 1), MOST_SHARDS)
    if shards == 1:
        return Tree([], [], 1)
    share = min(1.0, shards * SAMPLES / n)
    chance = F.pmod(F.xxhash64("print", F.lit(13)), F.lit(1 << 30)) / float(1 << 30)
    sample = [r["print"] for r in prints.where(chance < share).select("print").limit(2 * shards * SAMPLES).collect()]
    return grow(np.sort(np.array(sample, np.int64)).view(np.uint64), shards, reach)


def near_links(prints: DataFrame, tree: Tree, reach: int = RADIUS) -> DataFrame:
    """a, b: links that connect all distinct fingerprints (column print) within ``reach`` bits."""
    shared = prints.sparkSession.sparkContext.broadcast(tree)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, here, visit in shared.value.send(own, reach):
                places = np.concatenate([here, visit])
                yield batch_of(SENT, np.full(len(places), shard), own[places].view(np.int64), np.arange(len(places)) >= len(here))

    def link(shard: pa.Table) -> pa.Table:
        guest = shard.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        found = shard.column("print").to_numpy().view(np.uint64)
        own, visit = np.sort(found[~guest]), np.sort(found[guest])
        root = forest(own, visit, reach)
        both = np.concatenate([own, visit]).view(np.int64)
        some = np.flatnonzero(root != np.arange(len(both)))
        return pa.Table.from_batches([batch_of(LINKS, both[some], both[root[some]])], schema=LINKS)

    sent = prints.select("print").mapInArrow(send, "shard int, print bigint, guest boolean")
    return sent.groupBy("shard").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, size: int = SIZE, reach: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per input row.

    A-Z count as lower case. A text's fingerprint is taken over all its runs of ``size`` words,
    repeats included, or over all its words as one run if fewer; a text without words (null, empty)
    has the fingerprint zero and is linked like any other. component_id is the smallest doc_id
    reachable by fingerprints that differ in at most ``reach`` bits; rows of a null id belong to
    components but name none (null if there is no id at all). Repeated rows stay repeated, other
    columns are not read.
    """
    ship(docs.sparkSession)
    prints = saved(fingerprints(documents(docs, id_col, text_col), size), "simhash-prints")
    classes = saved(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-classes")
    tree = routing_tree(classes, classes.count(), reach, shard)
    labels = connected_components(saved(near_links(classes, tree, reach), "simhash-links"))
    named = saved(
        classes.join(labels.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print")),
        "simhash-components",
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    found = named.join(smallest, "component").select("print", "component_id")
    return prints.join(found, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
