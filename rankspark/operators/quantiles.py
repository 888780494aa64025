"""Exact quantiles of whole columns, without a task that holds a column's values.

``percentile`` as an aggregate gathers all distinct values of a column in one
task.  Here the columns are unpivoted and counted by value; the counts are
dealt by ranges of (column, value), so that a partition holds consecutive
values; the sums of the partitions (one row each) say in which of them a
wanted rank lies, and only those look for it, by a running sum of their own
counts.  Values between two ranks are interpolated linearly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import dbl
from ..session import drop_stored, materialize


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: dict[str, list[float]]) -> DataFrame:
    """One row: for each name the values at its ``probs``, an array of doubles (empty without any value)."""
    spark, names = df.sparkSession, list(columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), dbl(columns[c]).alias("x")) for i, c in enumerate(names)])
    counts = df.select(F.inline(pairs)).where("x is not null").groupBy("k", "x").agg(F.count(F.lit(1)).alias("c"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored, so that the partitions are the same for both looks at them
    ranged = materialize(counts.repartitionByRange(n, "k", "x").withColumn("pid", F.spark_partition_id()), "counts")
    # a row a partition, and one more for each column that ends inside one
    own = Window.partitionBy("k")
    sums = ranged.groupBy("pid", "k").agg(F.sum("c").alias("s")).select(
        "pid", "k", "s", (F.sum("s").over(own.orderBy("pid")) - F.col("s")).alias("start"), F.sum("s").over(own).alias("n"))
    wanted = F.element_at(F.array(*[F.array(*[F.lit(float(q)) for q in probs[c]]) for c in names]), F.col("k") + 1)
    place = sums.withColumn("q", F.explode(wanted)).withColumn("at", F.col("q") * (F.col("n") - 1))
    ranks = place.select("pid", "k", "start", "s", "n", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("r")) \
        .where((F.col("start") <= F.col("r")) & (F.col("r") < F.col("start") + F.col("s"))).distinct()
    running = ranged.join(F.broadcast(ranks.select("pid", "k").distinct()), ["pid", "k"]) \
        .withColumn("cum", F.sum("c").over(Window.partitionBy("pid", "k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)))
    last = F.col("r") - F.col("start")
    found = running.join(F.broadcast(ranks), ["pid", "k"]).where((F.col("cum") - F.col("c") <= last) & (last < F.col("cum"))).select("k", "n", "r", "x")
    # at most two values for each wanted quantile
    rows = found.collect()
    drop_stored(ranged)
    value = {(r.k, r.r): r.x for r in rows}
    size = {r.k: r.n for r in rows}

    def at(k: int, q: float) -> float:
        spot = q * (size[k] - 1)
        low, high = math.floor(spot), math.ceil(spot)
        a, b = value[k, low], value[k, high]
        return a if a == b else (high - spot) * a + (spot - low) * b

    schema = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in names])
    return spark.createDataFrame([[[at(k, q) for q in probs[c]] if k in size else [] for k, c in enumerate(names)]], schema)


def exact_medians(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row: the median of each column, null without any value."""
    one = exact_quantiles(df, columns, {c: [0.5] for c in columns})
    return one.select(*[F.get(c, F.lit(0)).alias(c) for c in columns])
