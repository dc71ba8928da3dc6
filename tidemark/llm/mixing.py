"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has an exponential key: -ln(u) / quality, u a hash of its id.
Within a source documents are taken in the order of their keys until the
source's token budget is met; a budget above the source's size takes whole
epochs first and the rest in key order. No source is sorted as a whole: keys are
summed in CELLS ranges, the range that holds the cut again, and only the rows of
that last sliver are put in order.

Sizes, weights, budgets and cuts are one row per source and saved; all that is
shuffled by row is the sliver. The main path is DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD, saved

# Ranges of keys at each of the two steps; a sliver is a source's rows over CELLS squared.
CELLS = 4096
# Characters that lower a document's quality, and its bounds.
JUNK = "0123456789#$%&*|_{}<>=/^~@+"
LEAST_QUALITY = 0.25
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
# What alike rows of a source share, in the order in which rows are taken.
ALIKE = ("_key", "_id", "_size", "_mark")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality(text: Column) -> Column:
    """1 for clean text, less as junk characters take a larger share, never below LEAST_QUALITY."""
    junk = F.length(text) - F.length(F.translate(text, JUNK, ""))
    return F.coalesce(F.greatest(F.lit(LEAST_QUALITY), 1 - 4 * junk / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the id alone, or without an id on the text."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), text), F.lit(""))
    digits = F.substring(F.md5(named.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """_id, _source, _size, _key, _mark (of the text) and the two cells of each row, beside its own columns."""
    text = docs[text_col].cast("string")
    rows = docs.select(
        "*", docs[id_col].cast("bigint").alias("_id"), docs[source_col].cast("string").alias("_source"), n_words(text).alias("_size"),
        (-F.log(uniform(docs[id_col].cast("bigint"), text)) / quality(text)).alias("_key"), F.xxhash64(text).alias("_mark"),
    )
    place = (1 - F.exp(-F.col("_key"))) * CELLS
    cell = F.least(F.floor(place), F.lit(CELLS - 1))
    return rows.withColumn("_cell", cell).withColumn(
        "_subcell", F.least(F.floor((place - F.col("_cell")) * CELLS), F.lit(CELLS - 1))
    )


def budgets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """_source, source_size, target, _epochs, _rest: one row per source.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    the sum of all sizes. A target stops at ``most_epochs`` times its source's
    size; what it would have beyond goes to the others by weight. The sources
    that stop are a prefix in the order of cap over weight.
    """
    sources = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1)
    everything = Window.partitionBy()
    in_order = Window.orderBy("_ratio", F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cap = most_epochs * F.col("source_size").cast("double")
    filled = (
        sources.withColumn("_weight", weight).withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_given", F.coalesce(F.sum("_cap").over(in_order), F.lit(0.0)))
        .withColumn("_weighed", F.coalesce(F.sum("_weight").over(in_order), F.lit(0.0)))
        .withColumn("_stops", F.col("_ratio") <= (F.col("_all") - F.col("_given")) / (F.col("_weights") - F.col("_weighed")))
        .withColumn("_full", F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0.0)).over(everything))
        .withColumn("_full_weight", F.sum(F.when(F.col("_stops"), F.col("_weight")).otherwise(0.0)).over(everything))
    )
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(
        F.col("_weight") * (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_full_weight"))
    )
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most_epochs))).otherwise(0)
    return filled.withColumn("target", target).withColumn("_epochs", epochs).select(
        "_source", "source_size", "target", "_epochs", (F.col("target") - F.col("_epochs") * F.col("source_size")).alias("_rest")
    )


def _cut(sums: DataFrame, cell: str) -> DataFrame:
    """The cell of each source in which the running size passes _rest, and the size before it."""
    running = Window.partitionBy("_source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_from") + F.coalesce(F.sum("_sum").over(running), F.lit(0))
    return sums.withColumn("_before", before).where(
        (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_sum"))
    )


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    renamed = right.withColumnRenamed("_source", "_source_of")
    return left.join(renamed, left["_source"].eqNullSafe(renamed["_source_of"]), how).drop("_source_of")


def cuts(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(cuts, sliver) of written ``rows``: where each source's budget is met.

    ``sliver`` has the rows in the cut's own subcell, ``_take`` of ``_count`` alike rows
    taken. A row is taken when more than half of it fits, so a
    source misses its target by half a document at most. Rows alike in id, size and text are
    one row of ``sliver`` that tells how many of them are taken.
    """
    plan = saved(budgets(rows, weights, most_epochs), "mix-budgets")
    sums = rows.groupBy("_source", "_cell").agg(F.sum("_size").alias("_sum"))
    first = _cut(_same_source(sums, plan).withColumn("_from", F.lit(0)), "_cell").select("_source", "_rest", "_cell", F.col("_before").alias("_from"))
    first = saved(first.withColumnRenamed("_cell", "_cut_cell"), "mix-cells")
    inside = _same_source(rows.select("_source", "_cell", "_subcell", "_size"), first).where("_cell = _cut_cell")
    sums = inside.groupBy("_source", "_subcell", "_rest", "_from", "_cut_cell").agg(F.sum("_size").alias("_sum"))
    second = _cut(sums, "_subcell").select("_source", "_cut_cell", F.col("_subcell").alias("_cut_subcell"), F.col("_before").alias("_from"))
    found = saved(_same_source(plan, second, "left"), "mix-cuts")

    alike = (
        _same_source(rows.select("_source", "_cell", "_subcell", *ALIKE), found)
        .where("_cell = _cut_cell AND _subcell = _cut_subcell")
        .groupBy("_source", *ALIKE, "_rest", "_from").agg(F.count(F.lit(1)).alias("_count"))
    )
    running = Window.partitionBy("_source").orderBy(*ALIKE).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.col("_from") - F.coalesce(F.sum(F.col("_size") * F.col("_count")).over(running), F.lit(0))
    # Copy number i, from 0, is taken if i * size + size / 2 still fits.
    fit = F.when(F.col("_size") == 0, F.when(left >= 0, F.col("_count")).otherwise(0)).otherwise(F.floor(left / F.greatest("_size", F.lit(1)) - 0.5) + 1)
    take = F.least(F.greatest(fit, F.lit(0)), F.col("_count")).cast("bigint")
    return found, saved(alike.select("_source", *ALIKE, "_count", take.alias("_take")), "mix-sliver")


def _alike(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the source and what alike rows share, nulls equal."""
    names = ["_source", *ALIKE]
    renamed = right.withColumnsRenamed({c: f"{c}_of" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & left[c].eqNullSafe(renamed[f"{c}_of"])
    return left.join(renamed, same, how).drop(*[f"{c}_of" for c in names])


def copies(rows: DataFrame, found: DataFrame, sliver: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and ``copies``: how often each is taken."""
    split = sliver.where("_take > 0 AND _take < _count")
    whole = _taken(_alike(_same_source(rows, found, "left"), sliver, "left"))
    if split.isEmpty():
        return whole
    # Of alike rows only some are taken: those rows are written and numbered.
    part = saved(_alike(rows, split, "inner").drop("_count").withColumn("_number", F.monotonically_increasing_id()), "mix-alike")
    chosen = _first_of(part).drop("_take", "_number")
    return whole.where("_take IS NULL OR _take = 0 OR _take = _count").unionByName(
        _taken(_same_source(chosen.withColumn("_take", F.col("_chosen").cast("bigint")).withColumn("_count", F.lit(1).cast("bigint")), found, "left")),
        allowMissingColumns=True,
    )


def _first_of(part: DataFrame) -> DataFrame:
    """``part`` with ``_chosen``: _take rows of each set of alike ones. They are counted in CELLS
    ranges by a hash of their numbers, and only the rows of the range that holds the cut are put in order."""
    names = ["_source", *ALIKE]
    placed = part.withColumn("_place", F.pmod(F.xxhash64("_number"), F.lit(CELLS)))
    counts = placed.groupBy(*names, "_place", "_take").agg(F.count(F.lit(1)).alias("_own"))
    running = Window.partitionBy(*names).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_own").over(running), F.lit(0)))
    cut = before.select(*names, "_place", (F.col("_take") - F.col("_before")).alias("_room"), "_own")
    known = _alike(placed, cut.withColumnRenamed("_place", "_place_of"), "inner").where("_place = _place_of")
    inside = F.row_number().over(Window.partitionBy(*names, "_place").orderBy("_number"))
    sure = known.where("_room >= _own OR _room <= 0").withColumn("_chosen", F.col("_room") > 0)
    edge = known.where("_room < _own AND _room > 0").withColumn("_chosen", inside <= F.col("_room"))
    return sure.unionByName(edge).drop("_place", "_place_of", "_room", "_own")


def _taken(rows: DataFrame) -> DataFrame:
    taken = (
        F.when(F.col("_take").isNotNull(), F.col("_take") > 0)
        .when(F.col("_cell") != F.col("_cut_cell"), F.col("_cell") < F.col("_cut_cell"))
        .otherwise(F.col("_subcell") < F.col("_cut_subcell"))
    )
    return rows.withColumn("copies", (F.col("_epochs") + F.coalesce(taken, F.lit(False)).cast("int")).cast("bigint"))


def mix_plan(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies: one row per input row.

    A null text has size 0; rows of size 0 take part and add nothing. A null
    source is a source of its own; rows of a null id are told apart by their texts. Of rows alike in
    id, size and text as many are taken as fit. Reruns give the same rows. An empty table gives none.
    """
    rows = saved(
        sized(docs.select(id_col, text_col, source_col), id_col, text_col, source_col)
        .select("_source", *ALIKE, "_cell", "_subcell"), "mix-sizes",
    )
    found, sliver = cuts(rows, weights, most_epochs)
    return copies(rows, found, sliver).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("_size")).alias("taken"), F.col("_source").alias("source"), "copies",
    )


def mix_rows(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan takes it.

    Rows without words go with the others of their source and key; those of a source that has no
    words at all are not taken.
    """
    names = [f"_own_{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    rows = sized(docs.toDF(*names), own[id_col], own[text_col], own[source_col])
    written = saved(rows.select("_source", *ALIKE, "_cell", "_subcell"), "mix-sizes")
    found, sliver = cuts(written, weights, most_epochs)
    repeated = copies(rows, found, sliver).where("copies > 0")
    return repeated.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*names).toDF(*docs.columns)


ORACLE = """
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || text, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u,
         length(text) - length(translate(text, '0123456789#$%&*|_{}<>=/^~@+', '')) AS junk
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / coalesce(greatest(0.25, 1 - 4 * junk / greatest(length(text), 1)::DOUBLE), 1.0) AS key FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size, 3 * sum(size)::DOUBLE AS cap FROM k GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
o AS (SELECT *, cap / weight AS ratio, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
             coalesce(sum(cap) OVER before, 0) AS given, coalesce(sum(weight) OVER before, 0) AS weighed
      FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, ratio <= (total - given) / (weights - weighed) AS stops FROM o),
g AS (SELECT *, sum(CASE WHEN stops THEN cap ELSE 0 END) OVER () AS full_size, sum(CASE WHEN stops THEN weight ELSE 0 END) OVER () AS full_weight FROM f),
t AS (SELECT source, source_size, CASE WHEN stops THEN cap ELSE weight * (total - full_size) / (weights - full_weight) END AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS epochs FROM t),
p AS (SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST((epochs + CASE WHEN size > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p
"""
