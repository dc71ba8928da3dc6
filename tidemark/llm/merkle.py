"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

Leaves of a group stand in ascending id order. Their places are counted, not
sorted: every 64 neighbouring ids are a word of a bitmap, merged by OR; 16 words are a
chunk that keeps its non-empty words only, each with the ids before it; and
chunks stand in a directory, a tree of 4096 children a node, whose counts summed from
the left give the ids before a chunk. A leaf's place is its rank there. Nodes
then meet by place alone: 16 slots are a run, and a run's hash is the node of the next level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import saved

# Children of a node.
RUN = 16
# Bits of an id inside a word, inside a chunk, and per directory level.
WORD_BITS = 6
CHUNK_BITS = 10
LEVEL_BITS = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    """The hash of a row's fields: ``-`` for null, else bytes, colon, value."""
    return digest(F.concat(*[_field(f) for f in fields]))


# -- coordinates -------------------------------------------------------------------


def bitmap(leaves: DataFrame) -> DataFrame:
    """gid, chunk, words, n: the ids of every group as chunks of non-empty 64-bit words.

    ``words`` maps a word's place in its chunk to (its bits, the chunk's ids before it). ``leaves`` has a group
    (gid) and an id that is unique in it.
    """
    word = F.shiftright("id", WORD_BITS)
    one = F.expr(f"shiftleft(1L, cast(id & {(1 << WORD_BITS) - 1} as int))")
    words = leaves.groupBy("gid", word.alias("word")).agg(F.bit_or(one).alias("bits"))
    place = (F.col("word").bitwiseAND((1 << (CHUNK_BITS - WORD_BITS)) - 1)).cast("int").alias("place")
    chunks = words.groupBy("gid", F.shiftright("word", CHUNK_BITS - WORD_BITS).alias("chunk")).agg(
        F.collect_list(F.struct(place, "bits")).alias("found"), F.sum(F.bit_count("bits")).alias("n")
    )
    before = lambda w: F.aggregate(
        "found", F.lit(0), lambda n, o: n + F.when(o["place"] < w["place"], F.bit_count(o["bits"])).otherwise(0)
    )
    entries = F.transform("found", lambda w: F.struct(w["place"], F.struct(w["bits"].alias("bits"), before(w).alias("below"))))
    return chunks.select("gid", "chunk", F.map_from_entries(entries).alias("words"), F.col("n").cast("bigint").alias("n"))


def directory(chunks: DataFrame) -> DataFrame:
    """gid, chunk, words, below: of every chunk, the ids of its group in the chunks before it.

    Each level sums the counts of at most 2 ** LEVEL_BITS children of one node, so no window grows with the data.
    """
    lowest, highest = chunks.agg(F.min("chunk"), F.max("chunk")).first()
    if lowest is None:
        return chunks.select("gid", "chunk", "words", F.lit(0).cast("bigint").alias("below"))
    shift, levels = 0, []
    counts = chunks.select("gid", F.col("chunk").alias("node"), "n")
    while True:
        top = (highest >> shift) - (lowest >> shift) < 1 << LEVEL_BITS
        above = F.lit(0) if top else F.shiftright("node", LEVEL_BITS)
        left = Window.partitionBy("gid", above).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        levels.append((shift, counts.select("gid", "node", F.coalesce(F.sum("n").over(left), F.lit(0)).alias("before"))))
        if top:
            break
        shift += LEVEL_BITS
        counts = saved(counts.groupBy("gid", above.alias("node")).agg(F.sum("n").alias("n")), "merkle-directory")
    placed = chunks.select("gid", "chunk", "words", F.lit(0).cast("bigint").alias("below"))
    for shift, level in levels:
        placed = placed.withColumn("node", F.shiftright("chunk", shift)).join(level, ["gid", "node"]).select(
            "gid", "chunk", "words", (F.col("below") + F.col("before")).alias("below")
        )
    return placed


def ranked(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """``leaves`` with pos, the number of the group's ids below a leaf's own."""
    within = F.element_at("words", F.shiftright(F.col("id").bitwiseAND((1 << CHUNK_BITS) - 1), WORD_BITS).cast("int"))
    lower = F.expr(f"~shiftleft(-1L, cast(id & {(1 << WORD_BITS) - 1} as int))")
    pos = F.col("below") + within["below"] + F.bit_count(within["bits"].bitwiseAND(lower))
    joined = leaves.withColumn("chunk", F.shiftright("id", CHUNK_BITS)).join(chunks, ["gid", "chunk"])
    return joined.select(*leaves.columns, pos.alias("pos"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with an id that ascends in ``order``, with gaps. Equal rows are told apart, so they are
    spread over tasks too. Written at once: a second run could number otherwise."""
    salted = rows.withColumn("_copy", F.monotonically_increasing_id())
    placed = salted.repartitionByRange(*order, "_copy").sortWithinPartitions(*order, "_copy")
    return saved(placed.withColumn("id", F.monotonically_increasing_id()).drop("_copy"), "merkle-numbered")


def coordinates(leaves: DataFrame) -> DataFrame:
    """Rows (gid, doc_id, leaf, start) with pos, their place in the group, and size, the group's rows.

    Where an id is missing or repeats in a group, its rows are told apart by numbers first that ascend
    by id (null first), leaf and start; all rows are then ranked by these numbers.
    """
    rows, known = leaves.groupBy().agg(F.count(F.lit(1)), F.count("doc_id")).first()
    keyed = leaves.withColumn("id", F.col("doc_id"))
    chunks = saved(bitmap(keyed.where("id IS NOT NULL")), "merkle-chunks")
    if known < rows or (chunks.agg(F.sum("n")).first()[0] or 0) < rows:
        keyed = numbered(leaves, ["gid", "doc_id", "leaf", "start"])
        chunks = saved(bitmap(keyed), "merkle-chunks")
    return _placed(keyed, chunks)


def _placed(keyed: DataFrame, chunks: DataFrame) -> DataFrame:
    ranks = ranked(keyed, saved(directory(chunks), "merkle-directory")).drop("id")
    return ranks.join(chunks.groupBy("gid").agg(F.sum("n").alias("size")), "gid")


# -- levels ------------------------------------------------------------------------


def _slots(nodes: DataFrame, held: list[str]) -> DataFrame:
    """Runs of nodes: gid, run, size, slots, each slot keyed by its place in the run.

    ``nodes`` has gid, pos, size (nodes of its group on this level) and node.
    """
    slot = F.struct((F.col("pos") % RUN).cast("int").alias("slot"), "node", *held)
    return nodes.groupBy("gid", F.floor(F.col("pos") / RUN).cast("bigint").alias("run")).agg(
        F.first("size").alias("size"), F.sort_array(F.collect_list(slot)).alias("slots")
    )


def _joined(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda s: s["node"]), "")


def reduce_levels(nodes: DataFrame, held: list[str], largest: int, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """(the runs of every level, the last node of each group as gid, node)."""
    levels, last = [], []
    while largest > 1:
        last.append(nodes.where("size = 1").select("gid", "node"))
        runs = saved(_slots(nodes.where("size > 1"), held if not levels else []), purpose)
        levels.append(runs)
        nodes = runs.select(
            "gid", F.col("run").alias("pos"), F.ceil(F.col("size") / RUN).cast("bigint").alias("size"),
            digest(_joined(F.col("slots"))).alias("node"),
        )
        largest = -(-largest // RUN)
    ends = nodes.where("size = 1").select("gid", "node")
    for some in last:
        ends = ends.unionByName(some)
    return levels, saved(ends, f"{purpose}-ends")


PATH = "array<struct<before:string,after:string>>"


def _down(runs: DataFrame, above: DataFrame, held: list[str]) -> DataFrame:
    """The nodes of ``runs`` with their path: what stands beside a node in its run, then beside each node above it.

    ``above`` has gid, pos and path of the nodes that the runs' hashes are.
    """
    met = runs.join(above.select("gid", F.col("pos").alias("run"), F.col("path").alias("rest")), ["gid", "run"])

    def beside(s: Column) -> Column:
        return F.struct(
            _joined(F.filter("slots", lambda x: x["slot"] < s["slot"])).alias("before"),
            _joined(F.filter("slots", lambda x: x["slot"] > s["slot"])).alias("after"),
        )

    nodes = F.transform("slots", lambda s: F.struct(s.alias("s"), beside(s).alias("beside")))
    each = met.select("gid", "run", "rest", F.explode(nodes).alias("x"))
    return each.select(
        "gid", (F.col("run") * RUN + F.col("x.s.slot")).alias("pos"), F.col("x.s.node").alias("node"),
        *[F.col(f"x.s.{c}").alias(c) for c in held], F.concat(F.array("x.beside"), F.col("rest")).cast(PATH).alias("path"),
    )


def paths(levels: list[DataFrame], tops: DataFrame, held: list[str]) -> DataFrame:
    """gid, pos, node, path of the lowest nodes of groups that have runs; ``tops``: gid, path of each group's last node.

    A group's last node has pos 0 on the level above its last runs, whichever level that is.
    """
    last = F.col("size") <= RUN
    below = None
    for depth in range(len(levels) - 1, -1, -1):
        runs = levels[depth]
        top = tops.join(runs.where(last).select("gid"), "gid").select("gid", F.lit(0).cast("bigint").alias("pos"), "path")
        above = top if below is None else below.select("gid", "pos", "path").unionByName(top)
        below = _down(runs, above, held if depth == 0 else [])
    return below


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and what stands beside its path give."""
    return F.aggregate(path, start, lambda node, p: digest(F.concat(p["before"], node, p["after"])))


def manifest(
    docs: DataFrame, fields: list[str], group_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, leaf, subroot, root, path, proof_sha256, folded_root, verified: one row per input row.

    A row's leaf hashes its ``fields`` in order (null: ``-``). Groups are the values of ``group_col``, null first;
    their leaves ascend by id, a missing id first, rows that share an id by leaf. ``path`` holds
    what stands before and after a node in its run, level by level to the root. A null id is never tampered with; where 5 divides
    the id's crc32 folded_root starts from the row with A-Z of its text lowered. Repeated rows each have a leaf; no rows
    give no rows. Columns that are not named are not read.
    """
    own = {name: docs[name] for name in {*fields, group_col, id_col, text_col}}
    tampered = {**own, text_col: F.translate(own[text_col].cast("string"), _UPPER, _LOWER)}
    key = own[id_col].cast("bigint")
    changed = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    # Group keys in order: null before all texts.
    gid = F.coalesce(F.concat(F.lit("+"), own[group_col].cast("string")), F.lit(""))
    leaves = saved(
        docs.select(
            gid.alias("gid"), key.alias("doc_id"), leaf_of([own[f] for f in fields]).alias("leaf"),
            F.when(changed, leaf_of([tampered[f] for f in fields])).alias("start"),
        ),
        "merkle-leaves",
    )
    placed = saved(coordinates(leaves).withColumnRenamed("leaf", "node"), "merkle-placed")
    held = ["doc_id", "start"]
    largest = placed.agg(F.max("size")).first()[0] or 0
    levels, ends = reduce_levels(placed, held, largest, "merkle-runs")

    # The subroots are the leaves of one more tree, placed by the order of their groups.
    groups = numbered(ends.select(F.lit("").alias("gid"), F.col("gid").alias("own_gid"), "node"), ["own_gid"])
    tops = saved(_placed(groups, saved(bitmap(groups), "merkle-chunks")), "merkle-tops")
    upper, root = reduce_levels(tops, ["own_gid"], ends.count(), "merkle-upper")
    empty = F.array().cast(PATH)
    if upper:
        top = root.select("gid", empty.alias("path"))
        over = paths(upper, top, ["own_gid"]).select(F.col("own_gid").alias("gid"), F.col("node").alias("subroot"), "path")
    else:
        over = tops.select(F.col("own_gid").alias("gid"), F.col("node").alias("subroot"), empty.alias("path"))
    over = saved(over.crossJoin(F.broadcast(root.select(F.col("node").alias("root")))), "merkle-over")

    if levels:
        low = paths(levels, over, held).select("gid", "node", *held, "path")
        alone = placed.where("size = 1").join(over.select("gid", "path"), "gid").select("gid", "node", *held, "path")
        every = low.unionByName(alone)
    else:
        every = placed.join(over.select("gid", "path"), "gid").select("gid", "node", *held, "path")
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    found = every.join(over.select("gid", "subroot", "root"), "gid").select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", digest(siblings).alias("proof_sha256"),
        fold(F.coalesce("start", "node"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


# SQL lets a group of one node stand, and makes every 16 the next level's node. LEVELS reach 16 ** 8 leaves.
LEVELS = 8
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda c: list_value(ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1)))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR END"


def _sql_levels(nodes: str, rows: str) -> list[str]:
    """``nodes`` (gid, pos, node, size) reduced to one a group, and each row of ``rows`` (gid, pos, proof, folded) led along."""
    parts = []
    for k in range(LEVELS):
        parts += [
            f"{nodes}_run{k} AS (SELECT gid, pos // {RUN} AS run, list(node ORDER BY pos) AS slots, any_value(size) AS size FROM {nodes}{k} GROUP BY ALL)",
            f"{nodes}{k + 1} AS (SELECT gid, run AS pos, CASE WHEN size = 1 THEN slots[1] ELSE sha256(array_to_string(slots, '')) END AS node, "
            f"(size + {RUN - 1}) // {RUN} AS size FROM {nodes}_run{k})",
            f"{rows}{k + 1} AS (SELECT * EXCLUDE (pos, proof, folded, _run, _size, before, after), _run AS pos, proof || before || after AS proof, "
            f"CASE WHEN _size = 1 THEN folded ELSE sha256(before || folded || after) END AS folded FROM (SELECT d.*, r.run AS _run, r.size AS _size, "
            f"array_to_string(slots[: pos % {RUN}], '') AS before, array_to_string(slots[pos % {RUN} + 2 :], '') AS after "
            f"FROM {rows}{k} d JOIN {nodes}_run{k} r ON d.gid = r.gid AND d.pos // {RUN} = r.run))",
        ]
    return parts


def oracle(fields: list[str]) -> str:
    leaf = "sha256(" + " || ".join(_sql_field(f) for f in fields) + ")"
    lowered = leaf.replace("text::VARCHAR", f"translate(text::VARCHAR, '{_UPPER}', '{_LOWER}')")
    crc = _CRC32.format("doc_id::VARCHAR")
    ctes = [
        f"leaves AS (SELECT doc_id, coalesce('+' || source, '') AS gid, {leaf} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {lowered} ELSE {leaf} END AS start FROM documents)",
        "a0 AS (SELECT gid, row_number() OVER (PARTITION BY gid ORDER BY doc_id) - 1 AS pos, leaf AS node, count(*) OVER (PARTITION BY gid) AS size, doc_id, start FROM leaves)",
        "d0 AS (SELECT gid, pos, doc_id, node AS leaf, '' AS proof, start AS folded FROM a0)",
        *_sql_levels("a", "d"),
        f"b0 AS (SELECT '' AS gid, row_number() OVER (ORDER BY gid) - 1 AS pos, node, count(*) OVER () AS size, gid AS own FROM a{LEVELS})",
        f"e0 AS (SELECT '' AS gid, b0.pos, doc_id, leaf, proof, folded, b0.node AS subroot FROM d{LEVELS} d JOIN b0 ON d.gid = b0.own)",
        *_sql_levels("b", "e"),
    ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, b.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b.node AS verified
FROM e{LEVELS} CROSS JOIN b{LEVELS} b
"""
