"""Connected components of a link table by alternating large and small stars.

Every round is two grouped minima with a join each, so a node with very many links
is pre-aggregated inside the tasks and no group is ever held by one. The links of a
round are written to the shared folder, where they replace those of the round before;
nothing but two sums reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.storage import discard, stored_at
from parcelyard.released import released


def _minima(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger node ``u`` to the smaller ``v``."""
    least = _minima(links)
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; a component is named by its least node.

    Links with a null end and links of a node to itself are ignored. An empty table
    gives an empty result. Takes a number of rounds that grows with the logarithm of
    the longest chain.
    """
    links, path = stored_at(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .filter("u <> v")
        .distinct()
    )
    mark = None
    while True:
        links, new = stored_at(_small_star(_large_star(links)))
        discard(links.sparkSession, path)
        path = new
        with released(links.sparkSession):
            found = links.agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
            ).first()
        if not found["n"] or found == mark:
            break
        mark = found
    heads = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        heads.select("v", "v")
    )
