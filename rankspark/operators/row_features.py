"""Row-local feature families (F1-F11) and row predicates.

All are single projections (one ``select`` per family) that stay inside
whole-stage codegen; source columns are optional as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (clip_lower, count_true, dbl, flag, ne_true, null_count,
                              row_mean, row_std, safe_divide)
from ..specs import (BUCKET_CROSS_KEY_SPECS, CROSS_KEY_SPECS, HELPER_PREFIXES, INV_COLS,
                     MISSINGNESS_EXCLUDE_COLS, PCT_COLS, RATE_COLS, ROW_ID,
                     ZERO_AS_MISSING_COLS)


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def add_missingness_features(df: DataFrame) -> DataFrame:
    """P9 ``nans_count``: nulls over every column except train-only, group, helper
    and row-id columns.  Counted at the stage where it runs (quirk Q1)."""
    src = [c for c in df.columns if c not in MISSINGNESS_EXCLUDE_COLS and c != ROW_ID
           and not c.startswith(HELPER_PREFIXES)]
    return df.select("*", (null_count(src) if src else F.lit(0)).alias("nans_count"))


def add_cross_keys(df: DataFrame, specs=CROSS_KEY_SPECS) -> DataFrame:
    """composite keys as a struct of the parts (no hashing needed;
    a null part is an ordinary key value, so joins on them use ``<=>``)."""
    new = [F.struct(*[F.col(c) for c in cols]).alias(name)
           for name, cols in specs if _has(df, *cols) and name not in df.columns]
    return df.select("*", *new) if new else df


def add_bucket_cross_keys(df: DataFrame) -> DataFrame:
    return add_cross_keys(df, BUCKET_CROSS_KEY_SPECS)


def add_temporal_features(df: DataFrame) -> DataFrame:
    """month, Monday=0 weekday, hour, ISO week, day of year, early_night,
    check-in month/weekday (search date + max(booking window, 0) days); drops
    ``date_time``."""
    if "date_time" not in df.columns:
        return df
    dt = F.col("date_time")
    hour = F.hour(dt)
    new = [
        F.coalesce(F.month(dt), F.lit(0)).alias("search_month"),
        F.coalesce(F.weekday(dt), F.lit(-1)).alias("search_dayofweek"),
        F.coalesce(hour, F.lit(-1)).alias("search_hour"),
        F.coalesce(F.weekofyear(dt), F.lit(0)).alias("search_weekofyear"),
        F.coalesce(F.dayofyear(dt), F.lit(0)).alias("search_dayofyear"),
        flag((hour >= 20) | (hour < 3)).alias("early_night"),
    ]
    if "srch_booking_window" in df.columns:
        bw = F.coalesce(clip_lower(F.col("srch_booking_window"), 0), F.lit(0)).cast("int")
        checkin = F.date_add(F.to_date(dt), bw)
        new += [F.coalesce(F.month(checkin), F.lit(0)).alias("checkin_month"),
                F.coalesce(F.weekday(checkin), F.lit(-1)).alias("checkin_dayofweek")]
    return df.select("*", *new).drop("date_time")


def add_trip_and_value_features(df: DataFrame) -> DataFrame:
    """price/trip arithmetic, visitor-history deltas, historical price,
    trip flags and quality/value scores."""
    cols = set(df.columns)

    def get(name, default):
        return dbl(name) if name in cols else F.lit(float(default))

    price = clip_lower(dbl("price_usd"), 0.0) if "price_usd" in cols else F.lit(0.0)
    price_log1p = F.log1p(price) if "price_usd" in cols else F.lit(0.0)
    stay = clip_lower(get("srch_length_of_stay", 1), 1.0)
    rooms = clip_lower(get("srch_room_count", 1), 1.0)
    adults = clip_lower(get("srch_adults_count", 1), 0.0)
    children = clip_lower(get("srch_children_count", 0), 0.0)
    people = clip_lower(adults + children, 1.0)
    new = [
        price_log1p.alias("price_log1p"),
        (price * stay * rooms).alias("total_fee"),
        safe_divide(price, stay).alias("price_per_night"),
        safe_divide(price, stay * rooms).alias("price_per_room_night"),
        safe_divide(price, people).alias("price_per_person"),
        people.alias("people_count"),
        safe_divide(rooms, people).alias("rooms_per_person"),
    ]
    if "visitor_hist_adr_usd" in cols:
        adr = dbl("visitor_hist_adr_usd")
        new += [(price - adr).alias("hist_adr_price_diff"),
                safe_divide(price, adr).alias("hist_adr_price_ratio")]
    if "prop_log_historical_price" in cols:
        hist = F.expm1(clip_lower(dbl("prop_log_historical_price"), 0.0))
        hist = F.when(hist > 0, hist)
        new += [(price - F.coalesce(hist, F.lit(0.0))).alias("price_diff_from_historical"),
                safe_divide(price, hist).alias("price_ratio_to_historical")]
    if "visitor_hist_starrating" in cols and "prop_starrating" in cols:
        new.append((dbl("prop_starrating") - dbl("visitor_hist_starrating")).alias("hist_star_diff"))
    if "prop_country_id" in cols and "visitor_location_country_id" in cols:
        new.append(ne_true(F.col("prop_country_id"), F.col("visitor_location_country_id"))
                   .cast("int").alias("international_bool"))
    new.append(flag((children > 0) | (people >= 4)).alias("family_trip_bool"))
    saturday = F.col("srch_saturday_night_bool").cast("int") if "srch_saturday_night_bool" in cols else F.lit(0)
    new.append(flag((stay <= 2) & (children == 0) & (people <= 2) & (saturday == 0)).alias("business_trip_bool"))
    star = get("prop_starrating", 0)
    review = F.coalesce(get("prop_review_score", 0), F.lit(0.0))
    loc1 = F.coalesce(get("prop_location_score1", 0), F.lit(0.0))
    loc2 = F.coalesce(get("prop_location_score2", 0), F.lit(0.0))
    new += [
        (star * review).alias("star_review_interaction"),
        safe_divide(price, F.when(star != 0, star)).alias("price_per_star"),
        safe_divide(price, F.when(review != 0, review)).alias("price_per_review"),
        safe_divide(star + review + loc1 + loc2, price_log1p + 1.0).alias("value_score"),
    ]
    return df.select("*", *new)


def add_competitor_features(df: DataFrame) -> DataFrame:
    """F8: row-wise summaries over the 8 competitor rate / inventory / pct columns."""
    rate = [c for c in RATE_COLS if c in df.columns]
    inv = [c for c in INV_COLS if c in df.columns]
    pct = [c for c in PCT_COLS if c in df.columns]
    new: list[Column] = []
    for name, cs in (("rate", rate), ("inv", inv)):
        if not cs:
            continue
        new += [
            null_count(cs).alias(f"comp_{name}_missing_count"),
            count_true(F.col(c).isNotNull() for c in cs).alias(f"comp_{name}_observed_count"),
            count_true(F.col(c) == 1 for c in cs).alias(f"comp_{name}_advantage_count"),
            count_true(F.col(c) == -1 for c in cs).alias(f"comp_{name}_disadvantage_count"),
        ]
        if name == "rate":
            new.append(count_true(F.col(c) == 0 for c in cs).alias("comp_rate_same_count"))
        new.append(row_mean(cs).alias(f"comp_{name}_mean"))
    if pct:
        new += [
            null_count(pct).alias("comp_pct_missing_count"),
            count_true(F.col(c).isNotNull() for c in pct).alias("comp_pct_observed_count"),
            row_mean(pct).alias("comp_pct_mean"),
            F.least(*[dbl(c) for c in pct]).alias("comp_pct_min") if len(pct) > 1 else dbl(pct[0]).alias("comp_pct_min"),
            F.greatest(*[dbl(c) for c in pct]).alias("comp_pct_max") if len(pct) > 1 else dbl(pct[0]).alias("comp_pct_max"),
            row_std(pct, 0.0).alias("comp_pct_std"),
        ]
    allc = rate + inv + pct
    if allc:
        new.append(null_count(allc).alias("comp_total_missing_count"))
    return df.select("*", *new) if new else df


def cleaned_missing(c: str) -> Column:
    """Numeric value with zero treated as missing for the listed columns."""
    x = dbl(c)
    return F.when(x != 0, x) if c in ZERO_AS_MISSING_COLS else x


def position_fit_source(fit: DataFrame) -> DataFrame:
    """P10: rows with a position, restricted to random_bool = 0 when any exist
    (quirk Q3: keeps the non-randomized rows); otherwise all of them.

    The 'any exist' test is a one-row aggregate cross-joined to the rows."""
    if "position" not in fit.columns:
        raise ValueError("position statistics need a position column")
    base = fit.filter(F.col("position").isNotNull())
    if "random_bool" not in base.columns:
        return base
    any_nr = base.agg(F.max(flag(F.col("random_bool") == 0)).alias("_any_nr"))
    return (base.select("*", any_nr.scalar().alias("_any_nr"))  # one-row statistic as a scalar subquery
            .filter((F.coalesce(F.col("_any_nr"), F.lit(0)) == 0) | (F.col("random_bool") == 0))
            .drop("_any_nr"))


def raw_id_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    """High-cardinality categoricals as text, null -> '-1'."""
    return df.select("*", *[F.coalesce(F.col(c).cast("long"), F.lit(-1)).cast("string").alias(f"{c}_cat")
                            for c in cols if c in df.columns])


def add_common_features(df: DataFrame) -> DataFrame:
    """Fixed order: nulls -> cross keys -> time -> trip/value -> competitors.
    (Within-search features follow in ``within_search``.)"""
    out = add_missingness_features(df)
    out = add_cross_keys(out)
    out = add_temporal_features(out)
    out = add_trip_and_value_features(out)
    return add_competitor_features(out)
