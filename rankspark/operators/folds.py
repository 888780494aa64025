"""Group-preserving splits and folds (V1-V7), query stats.

A search is never split: every assignment is made on the distinct-group
table and joined back on ``srch_id``.  Orderings over all groups use
``global_rank`` (range partitioning + per-partition offsets), never a
window without PARTITION BY, so no step funnels all groups into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import md5_key
from ..session import cut_lineage
from ..specs import BOOKING_COL, GROUP_COL, ROW_ID

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | record number


def global_rank(df: DataFrame, order: list[Column], name: str = "_grank",
                partitions: int | None = None) -> DataFrame:
    """Dense 1-based row number of ``df`` in ``order`` (a total order).

    Range-partition and sort, materialise (checkpoint, so partition contents are
    stable), count rows per partition (one small row per partition), and add the
    prefix offset of the partition to the record number inside it.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_df = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    sorted_df = cut_lineage(sorted_df)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = sorted_df.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)
    return out.withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + local + 1).drop("_pid", "_mid", "_off")


def query_start(df: DataFrame, group: str = GROUP_COL, ts: str = "date_time") -> DataFrame:
    return df.groupBy(group).agg(F.min(ts).alias("_start"))


def split_groups(df: DataFrame, strategy: str, valid_fraction: float, seed: int,
                 group: str = GROUP_COL, ts: str = "date_time",
                 min_one: bool = True) -> DataFrame:
    """V1-V3: table (group, is_valid).

    time: latest ``max(1, int(n*f))`` groups by first timestamp (tie: id);
    random: md5(id:seed) order, first n are validation (also when no timestamp);
    srch_id_quantile: highest ids.
    """
    if strategy == "time" and ts in df.columns:
        g = query_start(df, group, ts)
        order = [F.col("_start").desc(), F.col(group).desc()]
    elif strategy == "srch_id_quantile":
        g = df.select(group).distinct()
        order = [F.col(group).desc()]
    else:
        g = df.select(group).distinct()
        order = [md5_key(group, seed).asc(), F.col(group).asc()]
    ranked = global_rank(g, order)
    n = ranked.count()
    n_valid = int(n * valid_fraction)
    if min_one:
        n_valid = max(1, n_valid)
    return ranked.select(group, (F.col("_grank") <= n_valid).alias("is_valid"))


def make_group_split(df: DataFrame, strategy: str = "time", valid_fraction: float = 0.2,
                     seed: int = 2026, group: str = GROUP_COL) -> tuple[DataFrame, DataFrame]:
    """V1-V3 applied: (train rows, validation rows) via semi/anti joins."""
    if not 0.0 < valid_fraction < 0.5:
        raise ValueError("valid_fraction must be between 0 and 0.5")
    flags = cut_lineage(split_groups(df, strategy, valid_fraction, seed, group))
    valid_ids = flags.filter("is_valid").select(group)
    return df.join(valid_ids, group, "left_anti"), df.join(valid_ids, group, "left_semi")


def group_folds(df: DataFrame, n_splits: int, seed: int, group: str = GROUP_COL) -> DataFrame:
    """V4: shuffled balanced folds, fold = (md5 position - 1) % k; < 2 groups -> 0."""
    g = df.select(group).distinct()
    ranked = global_rank(g, [md5_key(group, seed).asc(), F.col(group).asc()])
    n = ranked.count()
    if n < 2 or n_splits < 2:
        return ranked.select(group, F.lit(0).alias("fold"))
    k = min(n_splits, n)
    return ranked.select(group, ((F.col("_grank") - 1) % k).cast("int").alias("fold"))


def search_month(df: DataFrame) -> Column:
    """V6: month of the search timestamp, else an existing column, else 0."""
    if "date_time" in df.columns:
        return F.coalesce(F.month("date_time"), F.lit(0))
    if "search_month" in df.columns:
        return F.coalesce(F.col("search_month").cast("int"), F.lit(0))
    return F.lit(0)


def query_strata_stats(df: DataFrame, group: str = GROUP_COL) -> DataFrame:
    """First random_bool and month (row order), max booking per query."""
    rb = F.coalesce(F.col("random_bool").cast("int"), F.lit(-1)) if "random_bool" in df.columns else F.lit(-1)
    hb = F.coalesce(F.col(BOOKING_COL).cast("int"), F.lit(0)) if BOOKING_COL in df.columns else F.lit(0)
    if ROW_ID not in df.columns:
        raise ValueError(f"the first row of a search is the one with the smallest {ROW_ID}, which is absent")
    order = F.col(ROW_ID)
    base = df.select(group, rb.alias("_rb"), search_month(df).alias("_m"), hb.alias("_hb"),
                     order.alias("_ord"))
    return base.groupBy(group).agg(F.min_by("_rb", "_ord").alias("random_bool"),
                                   F.min_by("_m", "_ord").alias("search_month"),
                                   F.max("_hb").alias("query_has_booking"))


def stratified_group_folds(df: DataFrame, n_splits: int, seed: int,
                           group: str = GROUP_COL) -> tuple[DataFrame, dict]:
    """V5: stratum = random_bool_month_hasBooking; strata with < k groups merge to
    'rare'; stratified when every stratum has >= k groups, else V4.

    Within a stratum groups are dealt round-robin in md5 order, so every fold
    holds floor(n/k) or ceil(n/k) of each stratum.  Returns (group, fold) and info.
    """
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2.")
    stats = cut_lineage(query_strata_stats(df, group))
    n = stats.count()
    if n < 2:
        return stats.select(group, F.lit(0).alias("fold")), {"strategy": "single_fold", "n_splits": 1, "n_groups": n}
    k = min(n_splits, n)
    stratum = F.concat_ws("_", F.col("random_bool").cast("string"), F.col("search_month").cast("string"),
                          F.col("query_has_booking").cast("string"))
    s = stats.select(group, stratum.alias("stratum"))
    sizes = s.groupBy("stratum").agg(F.count(F.lit(1)).alias("_size"))
    # one row per stratum: bounded by 3 x 13 x 2 values; broadcast is safe
    s = s.join(F.broadcast(sizes), "stratum").withColumn(
        "stratum", F.when(F.col("_size") < k, F.lit("rare")).otherwise(F.col("stratum")))
    s = cut_lineage(s.select(group, "stratum"))
    min_size = s.groupBy("stratum").count().agg(F.min("count")).first()[0]
    if min_size < k:
        return group_folds(df, k, seed, group), {"strategy": "shuffled_group", "n_splits": k, "n_groups": n}
    ranked = global_rank(s, [F.col("stratum").asc(), md5_key(group, seed).asc(), F.col(group).asc()])
    first = ranked.groupBy("stratum").agg(F.min("_grank").alias("_first"))
    folds = ranked.join(F.broadcast(first), "stratum").select(
        group, ((F.col("_grank") - F.col("_first")) % k).cast("int").alias("fold"))
    return folds, {"strategy": "stratified_group", "n_splits": k, "n_groups": n}


def attach_folds(df: DataFrame, folds: DataFrame, group: str = GROUP_COL) -> DataFrame:
    return df.join(folds.select(group, "fold"), group)


def fold_summary(df_with_fold: DataFrame, group: str = GROUP_COL) -> DataFrame:
    """Groups and rows per fold."""
    return (df_with_fold.groupBy("fold").agg(F.countDistinct(group).alias("groups"),
                                             F.count(F.lit(1)).alias("rows")))


def group_sizes(df: DataFrame, group: str = GROUP_COL) -> DataFrame:
    """Candidates per query, in query order (ranker group vector)."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
