"""Connected components of an undirected edge table.

Alternating large-star and small-star rounds: each round is one shuffle by
node whose group minimum is pre-aggregated, so a node with very many
neighbours is a plain skewed join that adaptive execution splits.  Rounds
grow with the logarithm of the longest path, and each is written to the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = near.groupBy("u").agg(F.min("v").alias("lo")).withColumn("lo", F.least("lo", "u"))
    joined = near.join(lowest, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("lo").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct("v", "lo"), F.struct(F.col("u").alias("v"), "lo"))).alias("e")) \
            .select(F.col("e.v").alias("u"), F.col("e.lo").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(node, root)`` for every node with an edge; root is the smallest reachable node.

    An empty edge table gives an empty result; self loops and repeated edges change nothing.
    """
    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = mark(now)
    while before[0]:
        now = stored(_star(_star(now, True), False), "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
