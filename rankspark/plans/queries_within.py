"""Within-search windows (W1-W9) and group splits/folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import folds as fo
from ..operators import metrics
from ..operators import row_features as rf
from ..operators import within_search as ws
from .catalog import labeled, register, round_doubles
from .oracle import with_base
from .queries_rows import _F3_EXPRS

W_COLS = ["price_usd", "prop_starrating", "prop_review_score", "prop_location_score2", "value_score"]
_SUFFIXES = ["mean_diff", "median_diff", "min_diff", "max_diff", "zscore", "pct_rank", "rank_asc", "rank_desc"]


def _w_sql(x: str, n: str) -> dict[str, str]:
    p = "PARTITION BY srch_id"
    return {
        f"{n}_srch_mean_diff": f"{x} - avg({x}) OVER ({p})",
        f"{n}_srch_median_diff": f"{x} - median({x}) OVER ({p})",
        f"{n}_srch_min_diff": f"{x} - min({x}) OVER ({p})",
        f"{n}_srch_max_diff": f"{x} - max({x}) OVER ({p})",
        f"{n}_srch_zscore": f"coalesce(({x} - avg({x}) OVER ({p})) / NULLIF(stddev_samp({x}) OVER ({p}), 0), 0)",
        f"{n}_srch_pct_rank": f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER ({p} ORDER BY {x} ASC NULLS LAST) + "
                              f"(count(*) OVER ({p}, {x}) - 1) / 2.0) / count({x}) OVER ({p}) END",
        f"{n}_srch_rank_asc": f"CASE WHEN {x} IS NOT NULL THEN CAST(rank() OVER ({p} ORDER BY {x} ASC NULLS LAST) AS DOUBLE) END",
        f"{n}_srch_rank_desc": f"CASE WHEN {x} IS NOT NULL THEN CAST(rank() OVER ({p} ORDER BY {x} DESC NULLS LAST) AS DOUBLE) END",
    }


def _w_all():
    e = {}
    for c in W_COLS:
        e.update(_w_sql("x_" + c, c))
    return e


_W = _w_all()
_WSRC = ("wsrc AS (SELECT srch_id, row_id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS x_{c}" for c in W_COLS[:-1]) + f", {_F3_EXPRS['value_score']} AS x_value_score FROM labeled)")
_FLAGS = {
    "price_order": "CAST(\"price_usd_srch_rank_asc\" AS DOUBLE)",
    "price_is_cheapest": "CAST(coalesce(price_usd_srch_rank_asc = 1, false) AS BIGINT)",
    "price_is_most_expensive": "CAST(coalesce(price_usd_srch_rank_desc = 1, false) AS BIGINT)",
    "review_is_best_in_search": "CAST(coalesce(prop_review_score_srch_rank_desc = 1, false) AS BIGINT)",
    "value_is_best_in_search": "CAST(coalesce(value_score_srch_rank_desc = 1, false) AS BIGINT)",
}


@register("w1_w5_within_search", with_base(
    _WSRC,
    "w AS (SELECT srch_id, row_id, " + ", ".join(f"{e} AS {n}" for n, e in _W.items()) + " FROM wsrc)",
    select="SELECT row_id, " + ", ".join(f"round({n}, 6) AS {n}" for n in _W)
           + ", " + ", ".join((f"round({e}, 6) AS {n}" if n == "price_order" else f"{e} AS {n}") for n, e in _FLAGS.items())
           + " FROM w"))
def w1_w5_within_search(spark, sf):
    log = rf.add_trip_and_value_features(labeled(spark, sf))
    out = ws.add_within_search_features(log.select("srch_id", "row_id", *W_COLS), W_COLS)
    return round_doubles(out.select("row_id", *_W, *_FLAGS))


@register("w6_score_rank_pct", with_base(select=(
    "SELECT row_id, round((rank() OVER (PARTITION BY srch_id ORDER BY prop_location_score1) + "
    "(count(*) OVER (PARTITION BY srch_id, prop_location_score1) - 1) / 2.0) / "
    "count(prop_location_score1) OVER (PARTITION BY srch_id), 6) AS prop_location_score1_rank_pct, "
    "round((rank() OVER (PARTITION BY srch_id ORDER BY price_usd) + "
    "(count(*) OVER (PARTITION BY srch_id, price_usd) - 1) / 2.0) / count(price_usd) OVER (PARTITION BY srch_id), 6) "
    "AS price_usd_rank_pct FROM labeled")))
def w6_score_rank_pct(spark, sf):
    out = ws.score_ranks(labeled(spark, sf), ["prop_location_score1", "price_usd"])
    return round_doubles(out.select("row_id", "prop_location_score1_rank_pct", "price_usd_rank_pct"))


@register("w7_top_k_per_search", with_base(select=(
    "SELECT srch_id, row_id, rank_in_group FROM (SELECT srch_id, row_id, CAST(row_number() OVER "
    "(PARTITION BY srch_id ORDER BY price_usd DESC, row_id) AS BIGINT) AS rank_in_group FROM labeled) "
    "WHERE rank_in_group <= 3")))
def w7_top_k_per_search(spark, sf):
    out = ws.top_k(labeled(spark, sf), [F.col("price_usd").desc(), F.col("row_id")], 3)
    return round_doubles(out.select("srch_id", "row_id", "rank_in_group"))


@register("w8_query_has_booking", with_base(select=(
    "SELECT row_id, CAST(max(booking_bool) OVER (PARTITION BY srch_id) AS BIGINT) AS query_has_booking FROM labeled")))
def w8_query_has_booking(spark, sf):
    out = metrics.add_query_has_booking(labeled(spark, sf))
    return round_doubles(out.select("row_id", "query_has_booking"))


RELATIVE_COLS = ["price_usd", "prop_starrating", "prop_review_score", "prop_location_score1",
             "prop_location_score2", "prop_log_historical_price"]


def relative_sql():
    e = {}
    p = "PARTITION BY srch_id"
    for c in RELATIVE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        for d, nl in (("asc", "ASC"), ("desc", "DESC")):
            e[f"{c}_rank_pct_{d}"] = (f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER ({p} ORDER BY {c} {nl} NULLS LAST) + "
                                      f"(count(*) OVER ({p}, {c}) - 1) / 2.0) / count({c}) OVER ({p}) END")
        e[f"{c}_diff_mean"] = f"{x} - avg({x}) OVER ({p})"
        e[f"{c}_diff_median"] = f"{x} - median({x}) OVER ({p})"
    lp = "ln(1 + greatest(CAST(price_usd AS DOUBLE), 0))"
    e["log_price_usd"] = lp
    e["value_star_per_log_price"] = f"CAST(prop_starrating AS DOUBLE) / NULLIF({lp}, 0)"
    e["value_review_per_log_price"] = f"CAST(prop_review_score AS DOUBLE) / NULLIF({lp}, 0)"
    return e


_D25 = relative_sql()


@register("w9_d25_relative_diagnostics", with_base(select=(
    "SELECT row_id, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _D25.items()) + " FROM labeled")))
def w9_d25_relative_diagnostics(spark, sf):
    out = ws.relative_diagnostics(labeled(spark, sf), RELATIVE_COLS)
    return round_doubles(out.select("row_id", *_D25))


# ---- splits and folds ------------------------------------------------------
@register("v1_time_split", with_base(
    "g AS (SELECT srch_id, min(date_time) AS t FROM labeled GROUP BY srch_id)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY t DESC, srch_id DESC) AS rn, count(*) OVER () AS n FROM g)",
    select="SELECT srch_id, rn <= greatest(1, CAST(floor(n * 0.15) AS BIGINT)) AS is_valid FROM r"))
def v1_time_split(spark, sf):
    return fo.split_groups(labeled(spark, sf), "time", 0.15, seed=2026)


@register("v2_random_split", with_base(
    "g AS (SELECT DISTINCT srch_id FROM labeled)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id) AS rn, "
    "count(*) OVER () AS n FROM g)",
    select="SELECT srch_id, rn <= greatest(1, CAST(floor(n * 0.15) AS BIGINT)) AS is_valid FROM r"))
def v2_random_split(spark, sf):
    return fo.split_groups(labeled(spark, sf).drop("date_time"), "random", 0.15, seed=2026)


@register("v3_id_quantile_split", with_base(
    "g AS (SELECT DISTINCT srch_id FROM labeled)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY srch_id DESC) AS rn, count(*) OVER () AS n FROM g)",
    select="SELECT srch_id, rn <= greatest(1, CAST(floor(n * 0.15) AS BIGINT)) AS is_valid FROM r"))
def v3_id_quantile_split(spark, sf):
    return fo.split_groups(labeled(spark, sf), "srch_id_quantile", 0.15, seed=2026)


@register("v4_shuffled_group_folds", with_base(
    "g AS (SELECT DISTINCT srch_id FROM labeled)",
    select="SELECT srch_id, CAST((row_number() OVER (ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id) - 1) "
           "% 5 AS BIGINT) AS fold FROM g"))
def v4_shuffled_group_folds(spark, sf):
    return round_doubles(fo.group_folds(labeled(spark, sf), 5, 2026))


_STRATA = [
    "st AS (SELECT srch_id, arg_min(coalesce(CAST(random_bool AS INTEGER), -1), row_id) AS rb, "
    "arg_min(coalesce(month(date_time), 0), row_id) AS m, max(coalesce(booking_bool, 0)) AS hb "
    "FROM labeled GROUP BY srch_id)",
    "s1 AS (SELECT srch_id, concat_ws('_', rb, m, hb) AS stratum FROM st)",
    "s2 AS (SELECT srch_id, CASE WHEN count(*) OVER (PARTITION BY stratum) < 5 THEN 'rare' ELSE stratum END AS stratum FROM s1)",
    "ok AS (SELECT min(c) >= 5 AS strat FROM (SELECT count(*) AS c FROM s2 GROUP BY stratum))",
    "fv AS (SELECT srch_id, CAST(CASE WHEN (SELECT strat FROM ok) THEN "
    "(row_number() OVER (PARTITION BY stratum ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id) - 1) % 5 "
    "ELSE (row_number() OVER (ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id) - 1) % 5 END AS BIGINT) "
    "AS fold FROM s2)",
]


@register("v5_stratified_group_folds", with_base(*_STRATA, select="SELECT srch_id, fold FROM fv"))
def v5_stratified_group_folds(spark, sf):
    folds_df, _ = fo.stratified_group_folds(labeled(spark, sf), 5, 2026)
    return round_doubles(folds_df)


@register("v6_a14_query_strata_stats", with_base(_STRATA[0], select=(
    "SELECT srch_id, CAST(rb AS BIGINT) AS random_bool, CAST(m AS BIGINT) AS search_month, "
    "CAST(hb AS BIGINT) AS query_has_booking FROM st")))
def v6_a14_query_strata_stats(spark, sf):
    return round_doubles(fo.query_strata_stats(labeled(spark, sf)))


@register("a15_fold_summary", with_base(*_STRATA, select=(
    "SELECT fold, count(DISTINCT srch_id) AS groups, count(*) AS rows FROM labeled JOIN fv USING (srch_id) GROUP BY fold")))
def a15_fold_summary(spark, sf):
    log = labeled(spark, sf)
    folds_df, _ = fo.stratified_group_folds(log, 5, 2026)
    return round_doubles(fo.fold_summary(fo.attach_folds(log, folds_df)))


@register("a13_group_sizes", with_base(select=(
    "SELECT srch_id, count(*) AS group_size FROM train GROUP BY srch_id")))
def a13_group_sizes(spark, sf):
    from .catalog import train
    return fo.group_sizes(train(spark, sf))
