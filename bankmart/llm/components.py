"""Connected components of a written table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Links every node's larger neighbours to the least node around it."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours to the least of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every linked node
    but the roots; ``links`` has the columns a < b."""
    while True:
        links = written(_small_star(_large_star(links)), "links")
        # done when all links lead straight to roots: a node has one, a root none
        n, nodes, inner = (links.select("b", F.lit(0).alias("up")).unionByName(links.select(F.col("a").alias("b"), F.lit(1).alias("up")).distinct())
                           .groupBy("b").agg(F.sum(1 - F.col("up")).alias("links"), F.max("up").alias("up"))
                           .agg(F.sum("links"), F.count_if(F.col("links") > 0), F.count_if((F.col("links") > 0) & (F.col("up") > 0))).first())
        if (n or 0) == nodes and not inner:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
