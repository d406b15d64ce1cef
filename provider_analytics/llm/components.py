"""Connected components of a graph given as pairs, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _stars(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included. ``pairs``: node, other."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return staged(least.withColumn("least", F.least("node", "least")), "least")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable from each node of ``links`` (a, b).

    Each round links every node's larger neighbours, then its smaller ones, to the
    smallest node it knows; both keep the components and end in stars around the roots.
    Rounds grow with the logarithm of a component's diameter. Every round is written,
    and its joins read plain tables, so that adaptive execution can split the rows of a
    node with very many neighbours.
    """
    links = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(),
        "links",
    )
    while True:
        both = staged(links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other"))), "both")
        large = both.join(_stars(both), "node").where("other > node")
        large = large.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        large = staged(large, "large")
        least = _stars(large)
        small = large.join(least, "node").where("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
        small = staged(small.union(least.select("node", F.col("least").alias("other"))).distinct(), "small")
        if _digest(small) == _digest(links):
            return links.select("node", F.col("other").alias("root")).union(
                links.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
            )
        links = small


def _digest(links: DataFrame) -> tuple:
    mixed = (F.bit_xor(F.xxhash64(*pair)) for pair in (("node", "other"), ("other", "node")))
    return tuple(links.agg(F.count(F.lit(1)), *mixed).first())
