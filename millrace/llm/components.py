"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """links: columns u, v of any orderable type. Returns (node, root), root the least node of the component.

    Nodes without a link to another are absent. Each step is a grouped minimum and a join, so a node with
    very many links is pre-aggregated and its rows split freely; the result of each step is stored, and only a
    count and a checksum come to the driver. The number of steps grows with the logarithm of the diameter.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "links")
    before = _mark(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stored(_star(both, larger=True), "large-star")
        edges = stored(_star(edges, larger=False), "small-star")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to the least node around it."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    around = edges.join(least, "u")
    if larger:
        out = around.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = around.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()
