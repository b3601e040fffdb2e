"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.session import write_out


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes in ``edges`` (a, b); the smallest node names it.

    Alternating large and small stars: each node's neighbours are linked to the
    smallest node near it, first the larger neighbours, then the smaller ones,
    until nothing changes. A node's neighbours are never gathered: the smallest
    comes from an aggregation and is joined back. Every step is written, so a
    lost executor costs that step only.
    """
    links = write_out(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = _linked(both, both.where("b > a"), own=True)
        links = _linked(links, links, own=False)
        state = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"),
        ).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _linked(near: DataFrame, moved: DataFrame, own: bool) -> DataFrame:
    """Link every ``moved`` neighbour of a node, or also the node, to its smallest one."""
    smallest = near.groupBy("a").agg(F.min("b").alias("m"))
    if own:
        smallest = smallest.withColumn("m", F.least("a", "m"))
    smallest = write_out(smallest, "smallest").withColumnRenamed("a", "node")
    made = moved.join(smallest, moved["a"] == smallest["node"]).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    if not own:
        made = made.unionByName(smallest.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return write_out(made.where("a <> b").distinct(), "links")
