"""Column names and feature spec tables.

FIXED VALUES: the names, key lists, bin counts and constants below must equal
the reference pipeline's for the derived columns to line up; they are stated
as plain data in their natural order.
"""

from __future__ import annotations

# ---- FIXED VALUES (must match the reference pipeline) ----------------------
GROUP_COL = "srch_id"
ITEM_COL = "prop_id"
TARGET_COL = "relevance"
GAIN_COL = "dcg_gain"
BOOKING_COL = "booking_bool"
CLICK_COL = "click_bool"
ROW_ID = "row_id"  # explicit row identity (pandas index in the reference)

TRAIN_ONLY_COLS = ("position", "gross_bookings_usd", "click_bool", "booking_bool",
                   "relevance", "dcg_gain")
MISSINGNESS_EXCLUDE_COLS = TRAIN_ONLY_COLS + ("srch_id",)
HELPER_PREFIXES = ("_key_",)

RELATIVE_FEATURE_BASES = (
    "price_usd", "price_log1p", "price_per_night", "price_per_room_night",
    "price_per_person", "prop_starrating", "prop_review_score",
    "prop_location_score1", "prop_location_score2", "prop_log_historical_price",
    "orig_destination_distance", "srch_query_affinity_score", "value_score",
    "comp_rate_missing_count", "comp_rate_observed_count",
    "comp_rate_advantage_count", "comp_rate_disadvantage_count",
    "comp_rate_same_count", "comp_rate_mean", "comp_inv_missing_count",
    "comp_inv_observed_count", "comp_inv_advantage_count",
    "comp_inv_disadvantage_count", "comp_inv_mean", "comp_pct_missing_count",
    "comp_pct_observed_count", "comp_pct_mean", "comp_pct_min", "comp_pct_max",
    "comp_total_missing_count",
)

LOW_CARD_CATEGORICAL_COLS = (
    "site_id", "visitor_location_country_id", "prop_country_id",
    "prop_brand_bool", "promotion_flag", "random_bool",
    "srch_saturday_night_bool", "search_month", "search_dayofweek",
    "search_hour", "search_weekofyear", "checkin_month", "checkin_dayofweek",
    "family_trip_bool", "business_trip_bool", "international_bool",
    "early_night",
)

TARGET_ENCODING_TARGETS = (
    ("relevance", "relevance"),
    ("dcg_gain", "gain"),
    ("booking_bool", "booking"),
    ("click_bool", "click"),
)

TARGET_KEY_SPECS = (
    ("prop_id", "prop"),
    ("srch_destination_id", "dest"),
    ("prop_country_id", "prop_country"),
    ("site_id", "site"),
    ("visitor_location_country_id", "visitor_country"),
    ("_key_prop_dest", "prop_dest"),
    ("_key_prop_country_visitor_country", "prop_country_visitor_country"),
    ("_key_dest_site", "dest_site"),
    ("price_usd_bucket", "price_bucket"),
    ("price_per_night_bucket", "price_per_night_bucket"),
    ("price_per_room_night_bucket", "price_room_night_bucket"),
    ("prop_log_historical_price_bucket", "hist_price_bucket"),
    ("srch_booking_window_bucket", "booking_window_bucket"),
    ("srch_length_of_stay_bucket", "stay_bucket"),
    ("_key_dest_price_bucket", "dest_price_bucket"),
    ("_key_site_price_bucket", "site_price_bucket"),
    ("_key_prop_country_price_bucket", "prop_country_price_bucket"),
    ("_key_dest_booking_window_bucket", "dest_booking_window_bucket"),
    ("_key_dest_stay_bucket", "dest_stay_bucket"),
)

POSITION_AGG_KEY_SPECS = (
    ("prop_id", "prop"),
    ("_key_prop_dest", "prop_dest"),
    ("_key_dest_site", "dest_site"),
    ("random_bool", "random"),
)

FREQUENCY_KEY_SPECS = (
    ("prop_id", "prop"),
    ("srch_destination_id", "dest"),
    ("prop_country_id", "prop_country"),
    ("site_id", "site"),
    ("visitor_location_country_id", "visitor_country"),
    ("_key_prop_dest", "prop_dest"),
    ("_key_dest_site", "dest_site"),
    ("price_usd_bucket", "price_bucket"),
    ("price_per_night_bucket", "price_per_night_bucket"),
    ("price_per_room_night_bucket", "price_room_night_bucket"),
    ("prop_log_historical_price_bucket", "hist_price_bucket"),
    ("srch_booking_window_bucket", "booking_window_bucket"),
    ("srch_length_of_stay_bucket", "stay_bucket"),
    ("_key_dest_price_bucket", "dest_price_bucket"),
    ("_key_site_price_bucket", "site_price_bucket"),
    ("_key_prop_country_price_bucket", "prop_country_price_bucket"),
    ("_key_dest_booking_window_bucket", "dest_booking_window_bucket"),
    ("_key_dest_stay_bucket", "dest_stay_bucket"),
)

AFFINITY_KEY_SPECS = (
    ("prop_dest_affinity", "prop_id", "srch_destination_id"),
    ("prop_site_affinity", "prop_id", "site_id"),
    ("prop_visitor_country_affinity", "prop_id", "visitor_location_country_id"),
    ("prop_country_visitor_country_affinity", "prop_country_id",
     "visitor_location_country_id"),
    ("dest_visitor_country_affinity", "srch_destination_id",
     "visitor_location_country_id"),
    ("dest_site_affinity", "srch_destination_id", "site_id"),
    ("prop_country_site_affinity", "prop_country_id", "site_id"),
)

BUCKET_SOURCE_SPECS = (
    ("price_usd", "price_usd_bucket", 20),
    ("price_per_night", "price_per_night_bucket", 20),
    ("price_per_room_night", "price_per_room_night_bucket", 16),
    ("prop_log_historical_price", "prop_log_historical_price_bucket", 16),
    ("srch_booking_window", "srch_booking_window_bucket", 16),
    ("srch_length_of_stay", "srch_length_of_stay_bucket", 12),
)

CROSS_KEY_SPECS = (
    ("_key_prop_dest", ("prop_id", "srch_destination_id")),
    ("_key_prop_country_visitor_country",
     ("prop_country_id", "visitor_location_country_id")),
    ("_key_dest_site", ("srch_destination_id", "site_id")),
)

BUCKET_CROSS_KEY_SPECS = (
    ("_key_dest_price_bucket", ("srch_destination_id", "price_usd_bucket")),
    ("_key_site_price_bucket", ("site_id", "price_usd_bucket")),
    ("_key_prop_country_price_bucket", ("prop_country_id", "price_usd_bucket")),
    ("_key_dest_booking_window_bucket",
     ("srch_destination_id", "srch_booking_window_bucket")),
    ("_key_dest_stay_bucket", ("srch_destination_id", "srch_length_of_stay_bucket")),
)

SEGMENT_PROFILE_SPECS = (
    ("prop_country", "prop_country_id"),
    ("dest", "srch_destination_id"),
    ("site", "site_id"),
    ("visitor_country", "visitor_location_country_id"),
    ("dest_site", "_key_dest_site"),
)

SEGMENT_PROFILE_SOURCE_COLS = (
    "price_usd", "price_per_night", "price_per_room_night", "prop_starrating",
    "prop_review_score", "prop_location_score1", "prop_location_score2",
    "prop_log_historical_price", "promotion_flag",
)

MISSING_VALUE_FEATURE_COLS = (
    "visitor_hist_starrating", "visitor_hist_adr_usd", "prop_review_score",
    "prop_location_score2", "orig_destination_distance",
    "srch_query_affinity_score", "prop_log_historical_price",
)

ZERO_AS_MISSING_COLS = ("prop_log_historical_price",)

PROP_PROFILE_SOURCE_COLS = (
    "price_usd", "prop_starrating", "prop_review_score", "prop_location_score1",
    "prop_location_score2", "prop_log_historical_price",
    "srch_query_affinity_score", "orig_destination_distance", "promotion_flag",
)

PROP_PROFILE_DELTA_COLS = (
    "price_usd", "prop_starrating", "prop_review_score", "prop_location_score1",
    "prop_location_score2", "prop_log_historical_price",
    "srch_query_affinity_score", "orig_destination_distance",
)

RAW_ID_CATEGORICAL_COLS = (
    "prop_id", "srch_destination_id", "site_id", "visitor_location_country_id",
    "prop_country_id", "prop_brand_bool", "promotion_flag", "random_bool",
    "srch_saturday_night_bool",
)

# Defaults of the pipeline parameters.
POPULARITY_ALPHA = 100.0
STACKING_MIN_DELTA = 0.003
# ---- end of fixed values ---------------------------------------------------

COMP_IDS = range(1, 9)
RATE_COLS = tuple(f"comp{i}_rate" for i in COMP_IDS)
INV_COLS = tuple(f"comp{i}_inv" for i in COMP_IDS)
PCT_COLS = tuple(f"comp{i}_rate_percent_diff" for i in COMP_IDS)
