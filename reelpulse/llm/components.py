"""Connected components of an edge table, on Spark.

Repeats two steps until the edges are stars around the least node of every
component: larger ends move to the least neighbour of their smaller end, then a
node's smaller neighbours connect to the least of them.  A round is one job of
three shuffles, written to the shared folder, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelpulse.llm.common import drop_stored, stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("low"), F.lit(False).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(None).cast(edges.schema["b"].dataType).alias("low"),
                     F.lit(True).alias("centre")))
    open_nodes = ends.groupBy("node").agg(
        F.min("low").alias("least"), F.max("low").alias("most"), F.max("centre").alias("centre"))
    return open_nodes.filter("least <> most or (least is not null and centre)").count() == 0


def _nearer(edges: DataFrame) -> DataFrame:
    """The edges (a > b) after both steps; some may repeat."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges["b"] == least["node"], "left").select("a", F.coalesce("m", "b").alias("b"))
    # one exchange: by the larger end serve the distinct and the minimum
    near = moved.repartition("a").distinct().withColumn("m", F.min("b").over(Window.partitionBy("a")))
    return near.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                       F.col("m").alias("b"))


def star_edges(edges: DataFrame) -> DataFrame:
    """Stored (a, b): every node of (a, b) ``edges`` but the least of its component,
    and that one.  Rows may repeat; stars among the edges need no more work."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
                   "cc_edges")
    while not _are_stars(edges):
        older, edges = edges, stored(_nearer(edges), "cc_edges")
        drop_stored(older)
    return edges


def star_nodes(stars: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``stars``."""
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) ``edges``; the component is
    its least node.  Nodes without edges are not listed."""
    return star_nodes(star_edges(edges))
