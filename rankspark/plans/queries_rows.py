"""Row-level operators: labels (P1), guards (P3/P4), null count (P9), position
source (P10), zero cleaning (P11), raw-id text (P14), features F1-F11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import finite_or_zero, safe_divide
from ..operators import row_features as rf
from ..specs import CROSS_KEY_SPECS, MISSINGNESS_EXCLUDE_COLS, RAW_ID_CATEGORICAL_COLS
from .catalog import labeled, register, round_doubles, train
from .oracle import with_base

RAW_COLS = (
    ["srch_id", "date_time", "site_id", "visitor_location_country_id", "visitor_hist_starrating",
     "visitor_hist_adr_usd", "prop_country_id", "prop_id", "prop_starrating", "prop_review_score",
     "prop_brand_bool", "prop_location_score1", "prop_location_score2", "prop_log_historical_price",
     "position", "price_usd", "promotion_flag", "srch_destination_id", "srch_length_of_stay",
     "srch_booking_window", "srch_adults_count", "srch_children_count", "srch_room_count",
     "srch_saturday_night_bool", "srch_query_affinity_score", "orig_destination_distance", "random_bool"]
    + [c for i in range(1, 9) for c in (f"comp{i}_rate", f"comp{i}_inv", f"comp{i}_rate_percent_diff")]
    + ["click_bool", "booking_bool", "gross_bookings_usd"]
)


def sd(a: str, b: str, fill: str = "0") -> str:
    """SQL safe divide."""
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), {fill})"


def clip(x: str, lo) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} ELSE {x} END)"


# ---- P1 -------------------------------------------------------------------
@register("p1_relevance_labels", with_base(select=(
    "SELECT row_id, CAST(relevance AS BIGINT) AS relevance, CAST(dcg_gain AS BIGINT) AS dcg_gain FROM labeled")))
def p1_relevance_labels(spark, sf):
    return round_doubles(labeled(spark, sf).select("row_id", "relevance", "dcg_gain"))


# ---- P3/P4 ----------------------------------------------------------------
@register("p3_p4_safe_divide_guard", with_base(select=(
    "SELECT row_id, round(" + sd("price_usd", "prop_starrating") + ", 6) AS price_per_star_raw, "
    "round(" + sd("visitor_hist_adr_usd", "srch_query_affinity_score", "-1") + ", 6) AS adr_per_affinity, "
    "round(CASE WHEN isfinite(CAST(visitor_hist_adr_usd AS DOUBLE) / CAST(prop_starrating AS DOUBLE)) "
    "THEN CAST(visitor_hist_adr_usd AS DOUBLE) / CAST(prop_starrating AS DOUBLE) ELSE 0 END, 6) AS adr_per_star_finite "
    "FROM search_log")))
def p3_p4_safe_divide_guard(spark, sf):
    """safe_divide(num, den, fill) and finite_or_zero on a raw ratio."""
    log = labeled(spark, sf)
    raw = F.try_divide(F.col("visitor_hist_adr_usd").cast("double"), F.col("prop_starrating").cast("double"))
    return round_doubles(log.select(
        "row_id",
        safe_divide(F.col("price_usd"), F.col("prop_starrating")).alias("price_per_star_raw"),
        safe_divide(F.col("visitor_hist_adr_usd"), F.col("srch_query_affinity_score"), -1.0).alias("adr_per_affinity"),
        finite_or_zero(raw).alias("adr_per_star_finite")))


# ---- P9 -------------------------------------------------------------------
_P9_COLS = [c for c in RAW_COLS if c not in MISSINGNESS_EXCLUDE_COLS]


@register("p9_nans_count", with_base(select=(
    "SELECT row_id, CAST(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _P9_COLS)
    + " AS BIGINT) AS nans_count FROM labeled")))
def p9_nans_count(spark, sf):
    out = rf.add_missingness_features(labeled(spark, sf))
    return round_doubles(out.select("row_id", "nans_count"))


# ---- P10 ------------------------------------------------------------------
@register("p10_position_fit_source", with_base(
    "b AS (SELECT * FROM train WHERE position IS NOT NULL)",
    "f AS (SELECT max(CASE WHEN random_bool = 0 THEN 1 ELSE 0 END) AS any_nr FROM b)",
    select=("SELECT CAST(random_bool AS BIGINT) AS random_bool, count(*) AS rows, "
            "round(avg(position), 6) AS position_mean FROM b, f "
            "WHERE coalesce(f.any_nr, 0) = 0 OR b.random_bool = 0 GROUP BY random_bool")))
def p10_position_fit_source(spark, sf):
    src = rf.position_fit_source(train(spark, sf))
    return round_doubles(src.groupBy("random_bool").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("position").alias("position_mean")))


# ---- P11 ------------------------------------------------------------------
@register("p11_zero_as_missing", with_base(select=(
    "SELECT row_id, round(CASE WHEN prop_log_historical_price <> 0 THEN prop_log_historical_price END, 6) "
    "AS prop_log_historical_price_clean, round(CAST(prop_review_score AS DOUBLE), 6) AS prop_review_score_clean "
    "FROM search_log")))
def p11_zero_as_missing(spark, sf):
    log = labeled(spark, sf)
    return round_doubles(log.select(
        "row_id", rf.cleaned_missing("prop_log_historical_price").alias("prop_log_historical_price_clean"),
        rf.cleaned_missing("prop_review_score").alias("prop_review_score_clean")))


# ---- P14 ------------------------------------------------------------------
@register("p14_raw_id_text", with_base(select=(
    "SELECT row_id, " + ", ".join(
        f"CAST(coalesce(CAST({c} AS BIGINT), -1) AS VARCHAR) AS {c}_cat" for c in RAW_ID_CATEGORICAL_COLS)
    + " FROM test")))
def p14_raw_id_text(spark, sf):
    from .catalog import test
    out = rf.raw_id_frame(test(spark, sf), list(RAW_ID_CATEGORICAL_COLS))
    return out.select("row_id", *[f"{c}_cat" for c in RAW_ID_CATEGORICAL_COLS])


# ---- F1/F2 ----------------------------------------------------------------
_F1_SQL = with_base(select="""
SELECT row_id,
 CAST(coalesce(month(date_time), 0) AS BIGINT) AS search_month,
 CAST(coalesce(isodow(date_time) - 1, -1) AS BIGINT) AS search_dayofweek,
 CAST(coalesce(hour(date_time), -1) AS BIGINT) AS search_hour,
 CAST(coalesce(weekofyear(date_time), 0) AS BIGINT) AS search_weekofyear,
 CAST(coalesce(dayofyear(date_time), 0) AS BIGINT) AS search_dayofyear,
 CAST(coalesce(hour(date_time) >= 20 OR hour(date_time) < 3, false) AS BIGINT) AS early_night,
 CAST(coalesce(month(CAST(date_time AS DATE) + CAST(coalesce(CASE WHEN srch_booking_window < 0 THEN 0 ELSE srch_booking_window END, 0) AS INTEGER)), 0) AS BIGINT) AS checkin_month,
 CAST(coalesce(isodow(CAST(date_time AS DATE) + CAST(coalesce(CASE WHEN srch_booking_window < 0 THEN 0 ELSE srch_booking_window END, 0) AS INTEGER)) - 1, -1) AS BIGINT) AS checkin_dayofweek
FROM search_log""")

_F1_COLS = ["search_month", "search_dayofweek", "search_hour", "search_weekofyear", "search_dayofyear",
            "early_night", "checkin_month", "checkin_dayofweek"]


@register("f1_f2_temporal", _F1_SQL)
def f1_f2_temporal(spark, sf):
    out = rf.add_temporal_features(labeled(spark, sf))
    return round_doubles(out.select("row_id", *_F1_COLS))


# ---- F3-F7 ----------------------------------------------------------------
_price = clip("CAST(price_usd AS DOUBLE)", "0.0")
_stay = clip("CAST(srch_length_of_stay AS DOUBLE)", "1.0")
_rooms = clip("CAST(srch_room_count AS DOUBLE)", "1.0")
_children = clip("CAST(srch_children_count AS DOUBLE)", "0.0")
_people = clip(f"({clip('CAST(srch_adults_count AS DOUBLE)', '0.0')} + {_children})", "1.0")
_hist = "(CASE WHEN exp(" + clip("CAST(prop_log_historical_price AS DOUBLE)", "0.0") + ") - 1 > 0 THEN exp(" + \
    clip("CAST(prop_log_historical_price AS DOUBLE)", "0.0") + ") - 1 END)"
_review = "coalesce(CAST(prop_review_score AS DOUBLE), 0.0)"
_star = "CAST(prop_starrating AS DOUBLE)"
_loc1 = "coalesce(CAST(prop_location_score1 AS DOUBLE), 0.0)"
_loc2 = "coalesce(CAST(prop_location_score2 AS DOUBLE), 0.0)"

_F3_EXPRS = {
    "price_log1p": f"ln(1 + {_price})",
    "total_fee": f"{_price} * {_stay} * {_rooms}",
    "price_per_night": sd(_price, _stay),
    "price_per_room_night": sd(_price, f"{_stay} * {_rooms}"),
    "price_per_person": sd(_price, _people),
    "people_count": _people,
    "rooms_per_person": sd(_rooms, _people),
    "hist_adr_price_diff": f"{_price} - visitor_hist_adr_usd",
    "hist_adr_price_ratio": sd(_price, "visitor_hist_adr_usd"),
    "price_diff_from_historical": f"{_price} - coalesce({_hist}, 0.0)",
    "price_ratio_to_historical": sd(_price, _hist),
    "hist_star_diff": f"{_star} - CAST(visitor_hist_starrating AS DOUBLE)",
    "international_bool": "CAST(coalesce(prop_country_id <> visitor_location_country_id, true) AS BIGINT)",
    "family_trip_bool": f"CAST(coalesce({_children} > 0 OR {_people} >= 4, false) AS BIGINT)",
    "business_trip_bool": f"CAST(coalesce({_stay} <= 2 AND {_children} = 0 AND {_people} <= 2 "
                          "AND srch_saturday_night_bool = 0, false) AS BIGINT)",
    "star_review_interaction": f"{_star} * {_review}",
    "price_per_star": sd(_price, f"NULLIF({_star}, 0)"),
    "price_per_review": sd(_price, f"NULLIF({_review}, 0)"),
    "value_score": sd(f"({_star} + {_review} + {_loc1} + {_loc2})", f"(ln(1 + {_price}) + 1.0)"),
}
_F3_INT = {"international_bool", "family_trip_bool", "business_trip_bool"}


@register("f3_f7_trip_value", with_base(select=(
    "SELECT row_id, " + ", ".join(
        (f"{e} AS {n}" if n in _F3_INT else f"round({e}, 6) AS {n}") for n, e in _F3_EXPRS.items())
    + " FROM search_log")))
def f3_f7_trip_value(spark, sf):
    out = rf.add_trip_and_value_features(labeled(spark, sf))
    return round_doubles(out.select("row_id", *_F3_EXPRS))


# ---- F8 -------------------------------------------------------------------
def _comp_sql():
    rate = [f"comp{i}_rate" for i in range(1, 9)]
    inv = [f"comp{i}_inv" for i in range(1, 9)]
    pct = [f"comp{i}_rate_percent_diff" for i in range(1, 9)]

    def cnt(cs, cond):
        return "(" + " + ".join(f"CAST(coalesce({cond.format(c)}, false) AS INTEGER)" for c in cs) + ")"

    def mean(cs):
        return (f"(CASE WHEN {cnt(cs, '{} IS NOT NULL')} > 0 THEN (" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cs)
                + f") / {cnt(cs, '{} IS NOT NULL')} END)")

    # row-wise stats via unnest of a list per row
    lst = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in pct) + "]"
    e = {}
    for name, cs in (("rate", rate), ("inv", inv)):
        e[f"comp_{name}_missing_count"] = cnt(cs, "{} IS NULL")
        e[f"comp_{name}_observed_count"] = cnt(cs, "{} IS NOT NULL")
        e[f"comp_{name}_advantage_count"] = cnt(cs, "{} = 1")
        e[f"comp_{name}_disadvantage_count"] = cnt(cs, "{} = -1")
        if name == "rate":
            e["comp_rate_same_count"] = cnt(cs, "{} = 0")
        e[f"comp_{name}_mean"] = mean(cs)
    e["comp_pct_missing_count"] = cnt(pct, "{} IS NULL")
    e["comp_pct_observed_count"] = cnt(pct, "{} IS NOT NULL")
    e["comp_pct_mean"] = mean(pct)
    e["comp_pct_min"] = f"list_min(list_filter({lst}, lambda x: x IS NOT NULL))"
    e["comp_pct_max"] = f"list_max(list_filter({lst}, lambda x: x IS NOT NULL))"
    e["comp_pct_std"] = f"coalesce(list_stddev_samp(list_filter({lst}, lambda x: x IS NOT NULL)), 0)"
    e["comp_total_missing_count"] = cnt(rate + inv + pct, "{} IS NULL")
    return e


_F8 = _comp_sql()


@register("f8_competitor", with_base(select=(
    "SELECT row_id, " + ", ".join(
        (f"round({x}, 6) AS {n}" if ("mean" in n or "pct_m" in n or "std" in n) else f"CAST({x} AS BIGINT) AS {n}")
        for n, x in _F8.items()) + " FROM search_log")))
def f8_competitor(spark, sf):
    out = rf.add_competitor_features(labeled(spark, sf))
    return round_doubles(out.select("row_id", *_F8))


# ---- F9-F11 ---------------------------------------------------------------
def _f9_sql():
    parts = []
    for name, (a, b) in CROSS_KEY_SPECS:
        parts.append(
            f"SELECT '{name}' AS key_name, count(*) AS distinct_keys, max(n) AS largest_group, "
            f"round(avg(n), 6) AS mean_group FROM (SELECT {a}, {b}, count(*) AS n FROM search_log GROUP BY {a}, {b})")
    return with_base(select=" UNION ALL ".join(parts))


@register("f9_f11_cross_keys", _f9_sql())
def f9_f11_cross_keys(spark, sf):
    """Composite keys (struct of parts) and their cardinality profile."""
    log = rf.add_cross_keys(labeled(spark, sf))
    out = None
    for name, _ in CROSS_KEY_SPECS:
        g = log.groupBy(name).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)).alias("distinct_keys"), F.max("n").alias("largest_group"),
            F.avg("n").alias("mean_group")).select(F.lit(name).alias("key_name"), "*")
        out = g if out is None else out.unionByName(g)
    return round_doubles(out)
