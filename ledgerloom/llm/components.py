"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import dropped, written


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the least of its neighbourhood: the larger ones, or the smaller ones and itself."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return hung.where("u <> v").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component): the least node each node of ``links`` (a, b) can reach, itself included.

    Every round is two joins on the links left; each round is written to the shared folder.  A node
    with a great many links is met by pre-aggregated minima and skew-split joins only.
    """
    spark = links.sparkSession
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
    edges, path = written(edges, "components")
    before = None
    while True:
        stepped, stepped_path = written(_towards_least(_towards_least(edges, True), False), "components")
        now = stepped.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        dropped(spark, path)
        edges, path = stepped, stepped_path
        if now == before:
            break
        before = now
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return children.unionByName(roots)
