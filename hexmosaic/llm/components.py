"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node in ``edges`` (a, b).

    Nodes are values of any ordered type. Minima are aggregated before they meet the edges again, in
    a plain join of two written tables, so a node of many edges is split among tasks. Every round is
    written to the shared folder; the driver sees a count and a checksum.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "minima")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "edges")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
