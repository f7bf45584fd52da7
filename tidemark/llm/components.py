"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable, forget


def _star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to its smallest neighbour (or itself), then each
    node's smaller neighbours do; both steps keep what is connected connected. The minimum per
    node is combined before the shuffle, and each round is written, so that a lost executor
    costs one round."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = durable(large.filter("u <> v").distinct(), "large")
    # here v < u: u's smaller neighbours and u itself meet in the smallest of them
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.toDF("u", "v"))
    out = durable(small.filter("u <> v").distinct(), "small")
    forget(large)
    return out


def components(links: DataFrame) -> DataFrame:
    """``links`` has two columns of node numbers. Returns ``node`` and ``root``, the smallest
    node reachable, for every node that has a link to another one. The rounds end when one
    changes nothing; each at least halves the depth."""
    edges = links.toDF("u", "v").filter("u <> v")
    edges = durable(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        before, edges = edges, _star(edges)
        forget(before)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = edges.toDF("node", "root")
            return roots.union(roots.select("root", "root").distinct())
        seen = state
