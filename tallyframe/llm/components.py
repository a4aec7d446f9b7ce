"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def downward(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges (u, v) with u > v; loops and edges with a NULL end are left out."""
    return edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def joined_up(edges: DataFrame) -> DataFrame:
    """One turn of alternating stars over edges (u, v), u > v: larger neighbours move to the smallest neighbour, then
    smaller ones do.  Components stay; stars joined to stars become one.  A hub is summed before the shuffle, and its
    edges are split by the join."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = stored(_to_smallest(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))  # used twice
    moved = _to_smallest(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return downward(moved, "u", "v").distinct()


def labels(forest: DataFrame) -> DataFrame:
    """(id, component) of the larger ends of edges: the least end they have an edge to.  Other ids are their own."""
    return forest.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) over edges (u, v), u > v: the smallest id that can be reached, for all ids but those that are
    the smallest of their component.  A logarithmic number of turns, until no edge moves."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = stored(joined_up(edges))
    before, last = mark(now), None
    while before[0] and before != last:
        now = stored(joined_up(now))
        before, last = mark(now), before
    return labels(now)
