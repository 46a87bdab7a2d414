"""Connected components of links between integer ids, by alternating stars.

Each round replaces every link by links to smaller ids: first from a node's larger
neighbours to its smallest, then from its smaller ones. It ends when the links are stars
around the smallest id of each component, which one aggregation over the ends tells; links
that are stars from the start take no round. A round is two aggregations, combined before
their shuffle, each joined back; rounds are landed, and only a flag reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.session import land


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is itself no larger end."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("to")).union(links.select("v", "v"))
    return ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high")).where("low < high").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked id but the smallest of each component, whose
    component is itself. Links with a null end, or from an id to itself, are no links."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b))
    links = land(links, "links")
    while not _stars(links):
        links = land(_small_star(_large_star(links)), "stars")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
