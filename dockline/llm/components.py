"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Per node that has a link: node, label (the smallest node of its component).

    Every round links the larger neighbours of a node, then the smaller ones,
    to its smallest neighbour, until nothing changes; the links stay as many
    or get fewer. Each round is written to the shared folder. A node with very
    many links is one row of the smaller side of each join, so the other side
    can be split. Null ends and links to oneself count for nothing.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    ).distinct()
    edges = materialize(edges, "links")
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct()
