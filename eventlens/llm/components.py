"""Connected components by alternating large-star and small-star rounds.

Every round is a group-by (partial minimum first, so a hub is no burden) and a
join; each writes its edges to the shared checkpoint folder.  The number of
rounds grows with the logarithm of the largest component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import cut_lineage


def _toward(least: DataFrame, pairs: DataFrame) -> DataFrame:
    return pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _toward(least, both.filter("b > a")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (_toward(least, down).unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; no nulls): the root is the smallest node reachable."""
    edges = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    mark = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
