"""Connected components of an edge list (large-star / small-star), in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not its component's
    root; the root is the smallest node of the component. No node's neighbours are
    ever gathered in one place: a step is one minimum per node (combined map-side)
    and one join, whose hot keys AQE may split. Edges from a node to itself are left out."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # done when every node has one neighbour or larger ones only: a root and its leaves
        if both.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m")).where("n > 1 and m < a").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        # every edge now points to a smaller node: join them to that node's smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                         .alias("e")).select("e.*").where("a <> b").distinct())
        now = written(small, "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges``, roots included."""
    found = stars(edges)
    return found.unionByName(found.select(F.col("root").alias("node"), "root")).distinct()
