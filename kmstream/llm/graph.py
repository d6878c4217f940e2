"""Connected components of an undirected graph, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import stored


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps in turn (Kiveris et al., SoCC 2014) until the
    edges no longer change. A node's smallest neighbour is a partial
    aggregation and goes back to its edges by a sort-merge join, so a node with
    very many edges is split by adaptive execution; no neighbour list is ever
    gathered. Each round is written to the shared folder, which cuts the
    lineage. Empty edges give an empty result; self loops and repeated edges
    are ignored.
    """
    def table(df, k):
        return stored(spark, df, f"components-{k}")

    def linked(a, b):
        return F.greatest(a, b).alias("a"), F.least(a, b).alias("b")

    now = table(edges.filter("a <> b").select(*linked(F.col("a"), F.col("b"))).distinct(), 0)  # a > b
    state = _digest(now)
    for k in range(1, rounds + 1):
        if not state[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a").select(*linked(F.col("b"), F.col("m"))).filter("a <> b").distinct())
        large = table(large, f"{k}l")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(*linked(F.col("b"), F.col("m")))
                 .union(least.select(*linked(F.col("a"), F.col("m")))).filter("a <> b").distinct())
        now = table(small, f"{k}s")
        before, state = state, _digest(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]
