"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.llm.common import Scratch


def components(links: DataFrame, a: str, b: str, scratch: Scratch | None = None) -> DataFrame:
    """For every node of a link, its component's least node: node, root. Each round is joins and minima by node on a
    table of at most the links' size, written to the shared folder; nothing is collected but a count and a checksum."""
    scratch = scratch or Scratch(links.sparkSession)
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.table(edges, "links")
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.table(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == mark:
            break
        mark = now
    # Every edge now leads to its component's least node.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
