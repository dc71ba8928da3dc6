"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) for every node of an undirected link table.

    Large stars hang every larger neighbour on a node's smallest one, small
    stars the smaller ones; both keep connections, and rounds grow with the
    logarithm of the longest chain. Each round is written, so a lost executor
    costs a round at most. A node with many links is joined on its smaller side
    only and can be split there. Links of a node to itself, and null ends, are left out.
    """
    edges = saved(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(links[a].isNotNull() & links[b].isNotNull() & (links[a] != links[b])).distinct(),
        "links",
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = saved(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
