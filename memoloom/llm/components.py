"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for each node of the edges ``a``, ``b``.

    Alternates two steps until nothing changes: each node links its larger neighbours to its smallest one,
    then each node links its smaller neighbours to the smallest of them (Kiveris et al., 2014). Each step is
    one aggregation and one join by node; links never leave the executors, and each round is checkpointed.
    The number of rounds grows with the logarithm of the longest path. Self links and repeated edges are
    harmless, nulls are dropped, no edges give no rows.
    """
    edges = cut(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b"))
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node"))).distinct()
    links = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before, links_before = None, links
    while True:
        # large star: over both directions, larger neighbours to the smallest of all and itself
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        links = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and itself to the smallest of them
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, links = links_before, cut(moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        drop(old)
        links_before = links
        after = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return nodes.join(links.select(F.col("a").alias("node"), "b"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
