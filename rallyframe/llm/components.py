"""Connected components of a link table, by alternating star contraction.

Each round is a few aggregations and equality joins on node ids, written to the shared scratch
folder, so nothing depends on blocks of one executor and no component is gathered anywhere. The
links of a node that very many have, as the centre of a star does, are dealt over ``SALTS`` tasks. The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallyframe.llm.scratch import write_scratch


#: Parts that a node's links are dealt into when they meet its least neighbour.
SALTS = 8


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (u, v) with m of ``least`` (u, m), salted by v. By merging: a node's SALTS rows aren't in Spark's estimate of the size."""
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.hash("v"), F.lit(SALTS))).join(salted.hint("merge"), ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour instead."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its least neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Tells sets of edges apart: how many they are, and 64-bit hashes of them taken together."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for each node of ``links`` (a, b).

    Links count both ways; repeated links and links of a node to itself change nothing, except
    that a node with none but the latter is not returned. Null ends are dropped. No links give
    no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = write_scratch(edges, "links")
    before = _digest(edges)
    while before[0]:
        edges = write_scratch(_small_star(_large_star(edges)), "links")
        now = _digest(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """node, component of ``groups`` (node, component) and ``links`` (a, b) together, as ``components`` of all their links gives them.

    Links are taken between groups, each once: however many join two groups, or lie within one, no round carries
    more than one. ``groups`` and ``links`` are tables that were written.
    """
    name = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    ends = links.where("a <> b").join(name("a"), "a", "left").join(name("b"), "b", "left")
    between = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    now = write_scratch(components(between), "merged").select(F.col("node").alias("component"), F.col("component").alias("now"))
    known = groups.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    fresh = now.select(F.col("component").alias("node"), F.col("now").alias("component")).join(groups.select("node"), "node", "left_anti")
    return known.unionByName(fresh)
