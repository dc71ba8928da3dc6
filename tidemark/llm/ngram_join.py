"""N-gram Jaccard join by vertical partitioning, and its near-duplicate components.

The n-grams' order is cut into fragments. A fragment's task sees every text's
part of it and counts alone; sums over fragments give a text's or a pair's
count. Three things are counted that way:

1. Which n-grams stand in two different sets at least. A set with under
   THRESHOLD of its n-grams among those can be similar to no other and leaves.
2. How often they stand there: rarer n-grams come first in the order of what
   is left, so sets that share only common passages do not meet.
3. The overlaps of candidate pairs, summed per pair and compared exactly.

Equal sets are one class throughout. Candidates share one of their first
n-grams (the prefix filter, shorter for the smaller set of a pair), each has as
many repeated n-grams as the pair must share, and what both share with a common
leader in each fragment, with what they have beside it, must suffice; none of these
loses a pair. Each set is compared with the
leaders of its prefix n-grams first, the sets with the fewest n-grams of their
own, and linked sets fall into one component; only pairs of sets that are still
apart are then compared one by one. So a group of near copies costs a few
comparisons per copy, and no link that could join two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import batch_of, documents, saved, ship, slices, utf8
from tidemark.llm.components import connected_components
from tidemark.llm.words import SPACES, hashed_words, lower_ascii, mix, shingles

SIZE = 5
# Similarity as a fraction: 100 * intersection >= 80 * union.
THRESHOLD = (80, 100)
# N-grams a fragment should hold at most, about, and the fewest fragments.
FRAGMENT_GRAMS = 4_000_000
LEAST_FRAGMENTS = 16
# Fragments in which a pair's overlap is counted.
PAIR_FRAGMENTS = 8
# Leaders per set whose overlaps rule pairs out.
HUBS = 4
# A posting is 48 bits of the n-gram's hash and 16 bits for the set in its slice.
SLOT_BITS = 16

SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])
SETS_SQL = "doc_id bigint, n bigint, s1 bigint, s2 bigint"
BLOBS = pa.schema([("fragment", pa.int32()), ("postings", pa.binary()), ("owners", pa.binary())])
BLOBS_SQL = "fragment int, postings binary, owners binary"
COUNTS = pa.schema([("s1", pa.int64()), ("r", pa.int64())])
PARTS = pa.schema([("s1", pa.int64()), ("grams", pa.binary())])
HEADS = pa.schema([("gram", pa.int64()), ("s1", pa.int64()), ("n", pa.int64()), ("r", pa.int64()), ("band", pa.int32()), ("early", pa.bool_())])
HEADS_SQL = "gram bigint, s1 bigint, n bigint, r bigint, band int, early boolean"
CUTS = pa.schema([("s1", pa.int64()), ("part", pa.int32()), ("grams", pa.binary())])
OVERLAPS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("part", pa.int32()), ("both", pa.int64())])


def _grams(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, ends = utf8(texts)
    words, at = hashed_words(lower_ascii(data), ends, ~SPACES)
    return shingles(words, at, size)


def _distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


def _marks(hashes: np.ndarray, owners: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: set size and two sums that stand for the set, whatever its order."""
    n = np.bincount(owners, minlength=texts)
    sums = []
    for salt in (0, 0x5851F42D4C957F2D):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))])
        at = np.concatenate([[0], np.cumsum(n)])
        sums.append(mix(running[at[1:]] - running[at[:-1]] + n.astype(np.uint64)))
    return n, sums[0], sums[1]


def gram_sets(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n, s1, s2 of rows (doc_id, text): the size and the identity of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, owners = _distinct(*_grams(batch.column("text"), size))
            n, s1, s2 = _marks(hashes, owners, batch.num_rows)
            yield batch_of(SETS, batch.column("doc_id"), n, s1.view(np.int64), s2.view(np.int64))

    return docs.mapInArrow(run, SETS_SQL)


def _postings(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """The postings of each slice of texts, cut into fragments; equal sets of a slice once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in slices(batches):
            for at in range(0, large.num_rows, 1 << SLOT_BITS):
                batch = large.slice(at, 1 << SLOT_BITS)
                hashes, owners = _distinct(*_grams(batch.column("text"), size))
                s1 = _marks(hashes, owners, batch.num_rows)[1]
                first = np.zeros(batch.num_rows, bool)
                first[np.unique(s1, return_index=True)[1]] = True
                kept = first[owners]
                low = np.uint64((1 << SLOT_BITS) - 1)
                keys = np.sort((hashes[kept] & ~low) | owners[kept].astype(np.uint64))
                cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                rows = [(f, keys[a:b]) for f, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                own = [np.unique(k & low, return_inverse=True) for _, k in rows]
                if rows:
                    yield batch_of(
                        BLOBS, [f for f, _ in rows],
                        [((k & ~low) | place.astype(np.uint64)).tobytes() for (_, k), (_, place) in zip(rows, own)],
                        [s1[who.astype(np.int64)].tobytes() for who, _ in own],
                    )

    return docs.mapInArrow(run, BLOBS_SQL)


def _repeated(fragment: pa.Table) -> pa.Table:
    """Of one fragment: the n-grams of two sets at least, as (place in the order, set).

    The place is the n-gram's frequency class, then 48 bits of its hash.
    """
    low = np.uint64((1 << SLOT_BITS) - 1)
    grams, who = [], []
    for keys, owners in zip(fragment.column("postings"), fragment.column("owners")):
        keys = np.frombuffer(keys.as_buffer(), np.uint64)
        grams.append(keys >> np.uint64(SLOT_BITS))
        who.append(np.frombuffer(owners.as_buffer(), np.uint64)[(keys & low).astype(np.int64)])
    gram, owner = np.concatenate(grams), np.concatenate(who)
    order = np.argsort(gram)
    gram = gram[order]
    again = np.zeros(len(gram) + 1, bool)
    again[1:-1] = gram[1:] == gram[:-1]
    some = np.flatnonzero(again[1:] | again[:-1])
    gram, owner = gram[some], owner[order[some]]
    order = np.lexsort((owner, gram))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    _, place, seen = np.unique(gram, return_inverse=True, return_counts=True)
    seen = seen[place]
    kept = seen >= 2
    rank = np.minimum(np.floor(4 * np.log2(np.maximum(seen[kept], 1))), 255).astype(np.uint64)
    gram, owner = (rank << np.uint64(48)) | gram[kept], owner[kept]
    order = np.argsort(owner, kind="stable")
    return pa.table(
        [[fragment.column("fragment")[0].as_py()], [gram[order].tobytes()], [owner[order].tobytes()]], schema=BLOBS
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per fragment and set, the repeated n-grams."""
    for batch in batches:
        for owners in batch.column("owners"):
            who, n = np.unique(np.frombuffer(owners.as_buffer(), np.uint64), return_counts=True)
            yield batch_of(COUNTS, who.view(np.int64), n)


def _by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A fragment's postings as one row per set."""
    for batch in batches:
        for grams, owners in zip(batch.column("postings"), batch.column("owners")):
            gram = np.frombuffer(grams.as_buffer(), np.int64)
            who, first = np.unique(np.frombuffer(owners.as_buffer(), np.uint64), return_index=True)
            who = who.view(np.int64)
            if not len(who):
                continue
            ends = np.append(first, len(gram)).astype(np.int32) * 8
            column = pa.BinaryArray.from_buffers(pa.binary(), len(who), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(gram.tobytes())])
            for at in range(0, len(who), 4096):
                yield batch_of(PARTS, who[at : at + 4096], column.slice(at, 4096))


def _least(n: int, threshold: tuple[int, int]) -> int:
    """Fewest n-grams a set of n must share with a similar one."""
    return -(-threshold[0] * n // threshold[1])


def _heads(threshold: tuple[int, int]):
    """The first n-grams of every set: one of them is shared with any similar set.

    ``early`` marks those among which a similar set that is not smaller must
    share one; a pair then has at least 2 t / (1 + t) of the smaller set.
    """
    most, of = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s1, n, grams in zip(batch.column("s1").to_pylist(), batch.column("n").to_pylist(), batch.column("grams")):
                gram = np.frombuffer(grams.as_buffer(), np.int64)
                head = gram[: max(0, len(gram) - _least(n, threshold) + 1)]
                k = len(head)
                early = np.arange(k) <= len(gram) - _least(n, (2 * most, most + of))
                # Sets whose sizes are within the threshold are in one band or in neighbours.
                band = int(np.floor(np.log(n) / np.log(of / most) + 1e-9))
                yield batch_of(HEADS, head, np.full(k, s1), np.full(k, n), np.full(k, len(gram)), np.full(k, band), early)

    return run


def _cut(parts: int):
    """A set's n-grams, cut into fragments by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s1, grams in zip(batch.column("s1").to_pylist(), batch.column("grams")):
                gram = np.frombuffer(grams.as_buffer(), np.int64)
                part = gram % parts
                yield batch_of(CUTS, np.full(parts, s1), np.arange(parts), [gram[part == p].tobytes() for p in range(parts)])

    return run


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [
            len(np.intersect1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True))
            for x, y in zip(batch.column("x"), batch.column("y"))
        ]
        yield batch_of(OVERLAPS, *[batch.column(c) for c in ("a", "b", "na", "nb", "part")], both)


def similar(both: Column, na: Column, nb: Column, threshold: tuple[int, int] = THRESHOLD) -> Column:
    return threshold[1] * both >= threshold[0] * (na + nb - both)


def _by_part(values: Column) -> Column:
    """Sums of ``values`` per fragment, as an array."""
    return F.array(*[F.sum(F.when(F.col("part") == p, values).otherwise(0)) for p in range(PAIR_FRAGMENTS)])


def _overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """a, b, na, nb, shares, both of pairs (a, b, na, nb): counted per fragment, summed per pair."""
    left = parts.select(F.col("s1").alias("a"), "part", F.col("grams").alias("x"))
    right = parts.select(F.col("s1").alias("b"), "part", F.col("grams").alias("y"))
    met = pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "na", "nb", "part", "x", "y")
    counted = met.mapInArrow(_overlap, "a bigint, b bigint, na bigint, nb bigint, part int, both bigint")
    return counted.groupBy("a", "b", "na", "nb").agg(_by_part(F.col("both")).alias("shares"), F.sum("both").alias("both"))


def _links(overlaps: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    return overlaps.where(similar(F.col("both"), F.col("na"), F.col("nb"), threshold)).select("a", "b")


def _fits(na: str, ra: str, nb: str, rb: str, threshold: tuple[int, int]) -> Column:
    """Whether sets of these sizes and counts of repeated n-grams can be similar."""
    most, of = threshold
    alike = of * F.least(na, nb) >= most * F.greatest(na, nb)
    return alike & ((most + of) * F.least(ra, rb) >= most * (F.col(na) + F.col(nb)))


def _leader_pairs(heads: DataFrame) -> DataFrame:
    """Every set with the leaders of its n-grams, of its own size band and the one below."""
    best = heads.groupBy("gram", "band").agg(F.min(F.struct((F.col("n") - F.col("r")).alias("own"), "s1", "n")).alias("lead"))
    best = best.select("gram", "band", F.col("lead.s1").alias("b"), F.col("lead.n").alias("nb"))
    asked = heads.select("gram", F.col("s1").alias("a"), F.col("n").alias("na"), F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    return asked.join(best, ["gram", "band"]).where("a <> b").select("a", "b", "na", "nb").distinct()


def _hubs(pairs: DataFrame, overlaps: DataFrame, parts: DataFrame) -> DataFrame:
    """s1, hubs: of the leaders a set was compared with, or is itself, the HUBS that were
    compared with most sets, each with the n-grams the two share per fragment."""
    sizes = parts.join(pairs.select(F.col("b").alias("s1")).distinct(), "s1", "left_semi").groupBy("s1").agg(
        _by_part(F.octet_length("grams") / 8).alias("shares"), F.sum(F.octet_length("grams") / 8).alias("both")
    )
    whole = "array<bigint>"
    own = sizes.select("s1", F.col("s1").alias("hub"), F.col("shares").cast(whole).alias("shares"), F.col("both").cast("bigint").alias("both"))
    met = overlaps.select(F.col("a").alias("s1"), F.col("b").alias("hub"), F.col("shares").cast(whole).alias("shares"), "both").unionByName(own)
    busy = overlaps.groupBy(F.col("b").alias("hub")).agg(F.count(F.lit(1)).alias("k"))
    return met.join(busy, "hub").groupBy("s1").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("k", "hub", "both", "shares")), asc=False), 1, HUBS).alias("hubs")
    )


def _open_pairs(heads: DataFrame, labels: DataFrame, hubs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs that may be similar and are in different components.

    In a n-gram's bucket the sets outside its largest component meet the others;
    those inside are connected already.
    """
    named = heads.join(labels.select(F.col("node").alias("s1"), "component"), "s1", "left").withColumn(
        "component", F.coalesce("component", "s1")
    )
    sizes = named.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("k"), F.max("early").alias("early"))
    main = sizes.groupBy("gram").agg(
        F.max(F.struct("k", "component")).alias("m"), F.count(F.lit(1)).alias("components"), F.max("early").alias("early")
    )
    open_grams = main.where("components > 1 AND early").select("gram", F.col("m.component").alias("main"))
    known = named.join(open_grams, "gram").withColumn("inside", F.col("component") == F.col("main")).join(hubs, "s1", "left")
    known = saved(known, "open-heads")
    names = {"s1": "", "n": "n", "r": "r", "component": "c", "inside": "i", "hubs": "h"}
    larger = known.select("gram", *[F.col(c).alias(f"{x}a") for c, x in names.items()])
    smaller = known.where("early").select(F.col("gram").alias("gram_b"), *[F.col(c).alias(f"{x}b") for c, x in names.items()])
    most, of = threshold
    needed = most * (F.col("na") + F.col("nb"))

    def too_few(x: Column, y: Column) -> Column:
        within = sum((F.least(x["shares"][p], y["shares"][p]) for p in range(PAIR_FRAGMENTS)), F.lit(0))
        beside = F.least(F.col("ra") - x["both"], F.col("rb") - y["both"])
        return (x["hub"] == y["hub"]) & ((most + of) * (within + beside) < needed)

    ruled_out = F.exists("ha", lambda x: F.exists("hb", lambda y: too_few(x, y)))
    apart = (
        (F.col("gram") == F.col("gram_b")) & (F.col("nb") <= F.col("na")) & (F.col("ca") != F.col("cb"))
        & _fits("na", "ra", "nb", "rb", threshold) & ~F.coalesce(ruled_out, F.lit(False))
    )
    met = larger.where("NOT ia").join(smaller, apart).unionByName(larger.where("ia").join(smaller.where("NOT ib"), apart))
    # Sets of one size meet both ways.
    turned = (F.col("na") == F.col("nb")) & (F.col("a") > F.col("b"))
    return met.select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"), "na", "nb"
    ).distinct()


def near_duplicates(
    docs: DataFrame, size: int = SIZE, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    A-Z count as lower case. A text's set is its distinct runs of ``size`` words, or
    all its words if fewer; a text without words (null, empty) has none, links with
    nothing and is its own component. component_id is the smallest doc_id reachable by links
    of at least ``threshold``; rows of a null id belong to components but name none. Repeated
    rows stay repeated. Sets are told apart by 128 bits, n-grams of two sets by 48.
    """
    ship(docs.sparkSession)
    sets, found = _grouped(documents(docs, id_col, text_col), size, threshold)
    return sets.join(found, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _grouped(rows: DataFrame, size: int = SIZE, threshold: tuple[int, int] = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, s1, s2 of every row; s1, s2, n, component, component_id of every distinct set)."""
    sets = saved(gram_sets(rows, size), "gram-sets")
    classes = saved(sets.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("first")), "gram-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_FRAGMENTS, -(-total // FRAGMENT_GRAMS)).bit_length()
    whole = _postings(rows.where("text IS NOT NULL"), size, bits).groupBy("fragment").applyInArrow(_repeated, BLOBS_SQL)
    fragments = saved(whole, "gram-fragments")

    shared = fragments.mapInArrow(_counts, "s1 bigint, r bigint").groupBy("s1").agg(F.sum("r").alias("r"))
    sizes = classes.groupBy("s1").agg(F.max("n").alias("n"))
    left = shared.join(sizes, "s1").where(threshold[1] * F.col("r") >= threshold[0] * F.col("n")).select("s1", "n")
    parts = fragments.mapInArrow(_by_set, "s1 bigint, grams binary").join(saved(left, "gram-left"), "s1")
    merged = parts.groupBy("s1", "n").agg(F.collect_list("grams").alias("parts"))
    kept = saved(merged.mapInArrow(_sorted, "s1 bigint, n bigint, grams binary"), "gram-kept")

    heads = saved(kept.mapInArrow(_heads(threshold), HEADS_SQL), "gram-heads")
    cuts = saved(kept.select("s1", "grams").mapInArrow(_cut(PAIR_FRAGMENTS), "s1 bigint, part int, grams binary"), "gram-parts")
    pairs = saved(_leader_pairs(heads), "leader-pairs")
    overlaps = saved(_overlaps(pairs, cuts), "leader-overlaps")
    links = _links(overlaps, threshold)
    labels = saved(connected_components(links), "gram-labels")
    hubs = saved(_hubs(pairs, overlaps, cuts), "gram-hubs")
    rest = saved(_links(_overlaps(_open_pairs(heads, labels, hubs, threshold), cuts), threshold), "gram-links")
    if not rest.isEmpty():
        labels = saved(connected_components(rest.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))), "gram-labels")

    named = classes.join(labels.withColumnRenamed("node", "s1"), "s1", "left").withColumn("component", F.coalesce("component", "s1"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    found = saved(named.join(smallest, "component").select("s1", "s2", "n", "component", "component_id"), "gram-components")
    return sets, found


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A set's n-grams from all fragments, in order."""
    schema = pa.schema([("s1", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])
    for batch in batches:
        grams = [np.sort(np.frombuffer(b"".join(p), np.int64)).tobytes() for p in batch.column("parts").to_pylist()]
        yield batch_of(schema, batch.column("s1"), batch.column("n"), grams)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with their columns.

    The row of the smallest id stays; rows without an id come after all others, in the
    order of their sets. Rows without words all stay. Of rows of one id and one set one stays.
    """
    ship(docs.sparkSession)
    sets, found = _grouped(documents(docs, id_col, text_col))
    names = [f"_own_{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    rows = docs.toDF(*names)
    key = rows[own[id_col]].cast("bigint")
    n, ids = sets.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:  # each row has an id of its own
        first = sets.join(found, ["s1", "s2", "n"], "left").where("n = 0 OR doc_id = component_id").select(F.col("doc_id").alias("_kept"))
        return rows.join(first.hint("shuffle_hash"), key == first["_kept"], "left_semi").toDF(*docs.columns)

    named = sets.where("n > 0").groupBy("s1", "s2", "doc_id").agg(F.count(F.lit(1)).alias("k")).join(found, ["s1", "s2"])
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "s1", "s2", "k")
    chosen = saved(named.groupBy("component").agg(F.min(order).alias("c")).select("c.doc_id", "c.s1", "c.s2", "c.k"), "gram-chosen")
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in ("_n", "_s1", "_s2")]])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own[text_col]):
            hashes, owners = _distinct(*_grams(batch.column(own[text_col]), SIZE))
            for name, values in zip(("_n", "_s1", "_s2"), _marks(hashes, owners, batch.num_rows)):
                batch = batch.append_column(name, pa.array(values.view(np.int64)))
            yield batch

    told = rows.mapInArrow(mark, schema)
    one, more = (chosen.where(c).select(F.col("doc_id").alias("_id"), F.col("s1").alias("_t1"), F.col("s2").alias("_t2")) for c in ("k = 1", "k > 1"))
    same = F.col(own[id_col]).cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_s1") == F.col("_t1")) & (F.col("_s2") == F.col("_t2"))
    kept = told.where("_n = 0").unionByName(told.where("_n > 0").join(one, same, "left_semi"))
    if not more.isEmpty():
        kept = kept.unionByName(told.where("_n > 0").join(more, same, "left_semi").dropDuplicates([own[id_col], "_s1", "_s2"]))
    return kept.select(*names).toDF(*docs.columns)
