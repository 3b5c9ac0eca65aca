"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from talkloom.llm.work import Work

MAX_ROUNDS = 60


def connected(edges: DataFrame, work: Work) -> DataFrame:
    """(v, root) for every node of (a, b) except the roots; a root is the smallest node of its component.

    Edges shrink to stars in a number of rounds that grows with the logarithm of the size. Minima
    are combined before the shuffle; a node with very many neighbours is a skewed
    join, which adaptive execution splits. Every round is written to the shared folder.
    """
    now = work.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = work.keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError("components did not settle")
