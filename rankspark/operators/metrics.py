"""Ranking evaluation: DCG/NDCG@k (E1-E4), baselines (E14-E17), fold tables.

NDCG uses ``row_number() <= k`` windows, which Spark turns into a
``WindowGroupLimit`` applied before the shuffle as well: every group ships at
most k rows per map task, so hot groups cannot blow up a reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..specs import GROUP_COL, ROW_ID, TARGET_COL
from .fitted import with_globals


def _gain(rel: Column) -> Column:
    return F.pow(F.lit(2.0), rel.cast("double")) - 1.0


def _discount(rank: Column) -> Column:
    return F.log2(rank.cast("double") + 1.0)


def dcg_by_group(df: DataFrame, order: list[Column], rel: str = TARGET_COL,
                 group: str | list[str] = GROUP_COL, k: int = 5,
                 name: str = "dcg") -> DataFrame:
    """Per-group DCG@k of relevance taken in ``order`` (total order expected)."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*order)
    top = df.select(*groups, F.col(rel).alias("_rel"), F.row_number().over(w).alias("_rn"))
    top = top.filter(F.col("_rn") <= k)
    return top.groupBy(*groups).agg(F.sum(_gain(F.col("_rel")) / _discount(F.col("_rn"))).alias(name))


def ndcg_by_group(df: DataFrame, score: str, rel: str = TARGET_COL,
                  group: str | list[str] = GROUP_COL, k: int = 5,
                  tie: str | None = ROW_ID, ascending: bool = False) -> DataFrame:
    """Per-group NDCG@k; a group without a positive label scores 0 (Q8)."""
    groups = [group] if isinstance(group, str) else list(group)
    s = F.col(score).asc() if ascending else F.col(score).desc()
    order = [s] + ([F.col(tie).asc()] if tie and tie in df.columns else [])
    dcg = dcg_by_group(df, order, rel, groups, k, "dcg")
    ideal_order = [F.col(rel).desc()] + ([F.col(tie).asc()] if tie and tie in df.columns else [])
    idcg = dcg_by_group(df, ideal_order, rel, groups, k, "idcg")
    out = dcg.join(idcg, groups)
    return out.select(*groups, F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg"))
                      .otherwise(F.lit(0.0)).alias("ndcg"))


def mean_ndcg(df: DataFrame, score: str, rel: str = TARGET_COL, group: str = GROUP_COL,
              k: int = 5, tie: str | None = ROW_ID, ascending: bool = False,
              name: str = "ndcg_at_5") -> DataFrame:
    """One-row mean NDCG@k over all groups."""
    per = ndcg_by_group(df, score, rel, group, k, tie, ascending)
    return per.agg(F.avg("ndcg").alias(name), F.count(F.lit(1)).alias("groups"))


def segment_ndcg(df: DataFrame, score_cols: list[str], segments: list[str],
                 rel: str = TARGET_COL, group: str = GROUP_COL, k: int = 5,
                 tie: str | None = ROW_ID) -> DataFrame:
    """NDCG per segment value; the segment is a row value, so (segment, group)
    is the grouping key.  Output: segment, value, score_col, ndcg, groups.

    The columns that this needs are stored once: each segment and score reads them twice."""
    keep = [group, rel, *([tie] if tie and tie in df.columns else []), *segments, *score_cols]
    df = materialize(df.select(*dict.fromkeys(keep)), "segments")
    parts = []
    for seg in segments:
        base = df.withColumn("_segment_value", F.col(seg).cast("string"))
        for sc in score_cols:
            per = ndcg_by_group(base, sc, rel, ["_segment_value", group], k, tie)
            parts.append(per.groupBy("_segment_value").agg(
                F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("groups"))
                .select(F.lit(seg).alias("segment"), F.col("_segment_value").alias("value"),
                        F.lit(sc).alias("score_col"), "ndcg", "groups"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def add_query_has_booking(df: DataFrame, booking: str = "booking_bool",
                          group: str = GROUP_COL) -> DataFrame:
    """max(booking) broadcast to every row of the query."""
    flags = df.groupBy(group).agg(F.max(booking).cast("int").alias("query_has_booking"))
    return df.join(flags, group)


def random_score(df: DataFrame, seed: int, name: str = "random_score") -> DataFrame:
    """md5-derived uniform score in [0, 1) (reproducible in SQL)."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(ROW_ID).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10)
    return df.withColumn(name, h.cast("double") / float(16 ** 8))


def popularity_score(fit: DataFrame, apply: DataFrame, key: str = "prop_id",
                     rel: str = TARGET_COL, alpha: float = 100.0,
                     name: str = "prop_pop_score") -> DataFrame:
    """(mean*n + global*alpha)/(n + alpha) fitted on ``fit``; unseen -> global.

    The per-key table is a partial/final hash aggregate; the global mean is a
    one-row aggregate cross-joined (broadcast, size 1).
    """
    glob = fit.agg(F.avg(F.col(rel).cast("double")).alias("_global"))
    table = fit.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                 F.avg(F.col(rel).cast("double")).alias("_mean"))
    table = table.transform(lambda _d: with_globals(_d, glob)).select(
        key, ((F.col("_mean") * F.col("_n") + F.col("_global") * alpha)
              / (F.col("_n") + alpha)).alias(name))
    out = apply.join(table, key, "left").transform(lambda _d: with_globals(_d, glob))
    return out.withColumn(name, F.coalesce(F.col(name), F.col("_global"))).drop("_global")


def heuristic_score(df: DataFrame, group: str = GROUP_COL, name: str = "heuristic_score") -> DataFrame:
    """Weighted within-search percentile ranks (good columns ranked descending
    so the best value gets the smallest rank, as in the reference); null rank -> 0.5."""
    from .within_search import pct_rank_average

    out = df
    for c in ("prop_starrating", "prop_review_score", "prop_location_score1",
              "prop_location_score2", "promotion_flag"):
        out = out.withColumn(f"_{c}_rank", pct_rank_average(c, group, ascending=False))
    out = out.withColumn("_price_rank_low", pct_rank_average("price_usd", group, ascending=True))
    score = (0.20 * (1 - F.coalesce(F.col("_price_rank_low"), F.lit(0.5)))
             + 0.25 * F.coalesce(F.col("_prop_starrating_rank"), F.lit(0.5))
             + 0.25 * F.coalesce(F.col("_prop_review_score_rank"), F.lit(0.5))
             + 0.20 * F.coalesce(F.col("_prop_location_score1_rank"), F.lit(0.5))
             + 0.05 * F.coalesce(F.col("_prop_location_score2_rank"), F.lit(0.5))
             + 0.05 * F.coalesce(F.col("promotion_flag").cast("double"), F.lit(0.0)))
    drop = [c for c in out.columns if c.endswith("_rank") and c.startswith("_")] + ["_price_rank_low"]
    return out.withColumn(name, score).drop(*drop)
