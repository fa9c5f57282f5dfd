"""Connected components of a link table, by alternating large and small stars.

Each round is two aggregations and two joins on node ids, and one more aggregation says
whether only stars are left; nothing but a count reaches the driver. Nodes with very many
links are numbers by the time they are shuffled (least neighbour per task), and their joins
can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.store import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the least of the neighbourhood."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return links.join(least, "a").select(F.col("least").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    others = links.join(least, "b").where("a <> least")
    moved = others.select(F.col("least").alias("x"), F.col("a").alias("y"))
    own = least.select(F.col("least").alias("x"), F.col("b").alias("y"))
    return moved.unionByName(own).distinct().select(F.col("x").alias("a"), F.col("y").alias("b"))


def _only_stars(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.col("b").alias("node"), F.lit(1).alias("smaller")).unionByName(
        links.select(F.col("a").alias("node"), F.lit(0).alias("smaller"))
    )
    loose = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.count("*").alias("n"))
    return not loose.where("smaller > 0 and n > 1").limit(1).count()


def stars(links: DataFrame) -> DataFrame:
    """(node, component) of every node but the least of its component.

    ``links`` has columns a and b. Self-links and rows with a null end say nothing.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    now = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(
        a.isNotNull() & b.isNotNull() & (a != b)
    )
    now = stored(now.distinct(), "links")
    while not _only_stars(now):
        now = stored(_small_star(_large_star(now)), "links")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached. Nodes without links have no row."""
    nodes = stars(links)
    component = F.col("component")
    return nodes.unionByName(nodes.select(component.alias("node"), component).distinct())
