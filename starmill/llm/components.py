"""Connected components of a table of links, by alternating large and small stars.

Every step is a grouping and a join on vertices; the links never leave Spark. A vertex with
very many links is a hot join key, which adaptive execution splits. A round reads the links
eight times at most, so its plan stays small, and rounds end with the one that leaves stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each vertex to its least one, itself included. At most one row a link."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each vertex ``u`` and its neighbours, all smaller, to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return links.join(least, "u").select(end.alias("u"), F.col("m").alias("v")).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every vertex is either the larger end of one link or the smaller end of any."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("_up")).union(links.select("v", F.lit(0)))
    degrees = ends.groupBy("x").agg(F.sum("_up").alias("_up"), F.count("*").alias("_all"))
    return degrees.where("_up > 0 AND _all > 1").count() == 0


def components(links: DataFrame) -> DataFrame:
    """(u, v) links to (id, component): the smallest id reachable. Unlinked ids are absent."""
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(links):
        links = written(_small_star(_large_star(links)))
    return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
