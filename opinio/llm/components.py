"""Connected components by alternating large-star and small-star rounds of Spark joins.

Every round is a partially aggregated minimum per node and a join back, on staged tables: a node with very
many links (the centre of a star) is reduced in the map tasks. Nothing is collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stage


def _is_forest_of_stars(links: DataFrame) -> bool:
    """Every upper node has one lower node, and no lower node is an upper one."""
    lower = links.select(F.col("v").alias("u")).distinct().withColumn("lower", F.lit(1))
    n, both = (links.groupBy("u").agg(F.count("*").alias("n")).join(lower, "u", "left")
               .agg(F.max("n"), F.max("lower")).first())
    return n is None or (n == 1 and both is None)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is its smallest reachable node."""
    links = stage(links.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while not _is_forest_of_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: the larger neighbours of a node move to its smallest neighbour.
        links = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u != v").distinct(), "links")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        links = stage(links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                      .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
