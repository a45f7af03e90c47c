"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that links ``a, b`` reach, for every node in them.

    Alternating stars: each node hands its larger neighbours, then its smaller ones, to the
    smallest; after a few rounds every node hangs on the smallest of its component.  Each
    step is a written table, and the smallest neighbours are counted together before they
    are joined, so a node with very many links is split like any skewed key.  Links with a
    null end and from a node to itself count for nothing.
    """
    edges = materialize(_ordered(links))
    while not _all_stars(edges):
        edges = _star(edges, larger=True)
        edges = _star(edges, larger=False)
    own = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return own.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("component")))


def _all_stars(edges: DataFrame) -> bool:
    """True when every node hangs on one other, which hangs on none."""
    ends = edges.select(F.col("a").alias("u"), F.lit(2).alias("n")).unionByName(
        edges.select(F.col("b").alias("u"), F.lit(1).alias("n"))
    )
    odd = ends.groupBy("u").agg(F.sum("n").alias("n"), F.min("n").alias("low"), F.max("n").alias("high"))
    return odd.where("low = 1 and (high = 2 or n > 1)").isEmpty()


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links with the smaller end first."""
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("__both"))
    return ends.where("__both and a < b").select("a", "b").distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hand neighbours to the smallest neighbour (or the node itself, if that is smaller)."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = down.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) if larger else down
    least = materialize(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    handed = near.where("v > u") if larger else near
    made = handed.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not larger:
        made = made.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return materialize(_ordered(made))
