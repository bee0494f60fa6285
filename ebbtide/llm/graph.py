"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): the smallest node
    that is reachable.

    Alternates large-star and small-star steps, which hang every node below the
    smallest neighbour known so far. Steps are joins and minimum aggregations; a
    node with very many links is combined before the shuffle, and its join partition is
    one that adaptive execution can split. Only two sums per round reach the driver.
    """
    edges = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = stored(
            both.join(lowest, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        edges = stored(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(own)
