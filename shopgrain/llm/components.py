"""Connected components of a graph that no single machine has to hold.

Alternating large-star and small-star steps (each node's larger, then its smaller neighbours are
linked to the least node around) until the links stop changing; a logarithmic number of rounds in
practice. Sums are combined before every shuffle, and joins on a hub are ones that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.checkpoints import materialise


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node that has a link.

    ``links`` has two columns of one orderable type. Links of a node with itself, repeated links
    and links with a null end change nothing.
    """
    a, b = links.columns
    links = links.where(F.col(a) != F.col(b))
    now = materialise(
        links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct(), "links"
    )
    size = _state(now)
    while size[0]:
        large = _large_star(now)
        now = materialise(_small_star(large), "links")
        size, before = _state(now), size
        if size == before:
            break
    roots = now.groupBy("node").agg(F.min("root").alias("root"))
    return roots.unionByName(now.select(F.col("root").alias("node"), "root").distinct())


def _state(links: DataFrame) -> tuple:
    """Number and order-free digest of the links: equal before and after a round only if nothing moved."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("root", "node")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """node > root in every link, so a node's smaller neighbours are its roots."""
    least = links.groupBy("node").agg(F.min("root").alias("m"))
    moved = links.join(least, "node").where("root > m").select(F.col("root").alias("node"), F.col("m").alias("root"))
    return moved.union(least.select("node", F.col("m").alias("root"))).distinct()
