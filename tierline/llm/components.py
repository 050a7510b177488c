"""Connected components of a graph given by its edges, by alternating stars."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang a node's neighbours (``large``: those above it, else those below it and the
    node itself) on the smallest of them all."""
    if large:
        around = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    else:
        around = edges
    around = around.toDF("node", "other")
    least = around.groupBy("node").agg(F.min("other").alias("least"))
    hung = around.join(least.withColumn("least", F.least("least", "node")), "node")
    if large:
        moved = hung.where("other > node").select(F.col("other").alias("high"), F.col("least").alias("low"))
    else:
        moved = hung.select(F.explode(F.array("node", "other")).alias("high"), F.col("least").alias("low"))
    return moved.where("high <> low").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of ``edges`` (``a``,
    ``b``, both long) but the roots.

    Every pass is two grouped minima; its edges are written to the shared folder, which
    cuts the lineage, and summed up as they are written, which shows when nothing moves. The number of passes grows with the logarithm of the graph's size.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    mark = None
    while True:
        seen = Observation()
        mixed = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        starred = _star(_star(current, True), False).observe(seen, F.count(F.lit(1)).alias("n"), mixed.alias("mixed"))
        current = stage(starred, "edges")
        if seen.get == mark:
            return current.select(F.col("high").alias("node"), F.col("low").alias("root"))
        mark = seen.get
