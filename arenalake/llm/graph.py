"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import written


def _minima(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours. A map-side combined aggregate, so a hub is cheap."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest neighbour of u."""
    pairs = _both(edges)
    return (
        pairs.join(_minima(pairs), pairs["u"] == F.col("w"))
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them. Edges point from large to small."""
    least = _minima(edges)
    tied = edges.join(least, edges["u"] == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).filter("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one end: it is tied to one smaller node, or others are tied to it, never both."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per_node.filter("up + down > 1 AND up > 0").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of `edges` (columns a, b); component is the smallest reachable id.

    Alternating large and small stars: each round is written, so lineage stays short, and rounds grow
    with the logarithm of the longest chain. Edges that are stars already need no round. Self loops and
    repeated edges do no harm; no edges give no rows.
    """
    now = written(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _settled(now):
        now = written(_small_star(_large_star(now)), "stars")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`classes` (id, component) joined up by `links` (a, b) between components; ids without a class are their own.

    Only the links go through the stars again, not the edges behind `classes`.
    """
    if not links.limit(1).count():
        return classes
    joined = written(components(links).select(F.col("id").alias("old"), F.col("component").alias("new")), "joined")
    known = classes.join(joined, F.col("component") == F.col("old"), "left").select("id", F.coalesce("new", "component").alias("component"))
    alone = joined.join(classes, F.col("old") == F.col("id"), "left_anti")
    return written(known.union(alone.select(F.col("old").alias("id"), F.col("new").alias("component"))), "classes")
