"""Connected components of an edge table by alternating stars.

Neighbours are never listed in one row; the edges of a hot node meet in a join, whose partition adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import store


def _star(pairs: DataFrame, lower: bool) -> DataFrame:
    """Tie the neighbours ``b`` of each ``a`` (those above it, or with ``lower`` all of them) to the smallest of them and ``a``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    found = pairs.join(least, "a")
    tied = found.where("b > a OR b > m" if lower else "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.where("m < a").select("a", F.col("m").alias("b")) if lower else None
    return (tied.unionByName(own) if lower else tied).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``edges(a, b)``; the component is its smallest node."""
    stars, before = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"), None
    while True:
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if state == before or not state.n:
            break
        before = state
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = store(_star(_star(both, lower=False), lower=True), "stars")
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
