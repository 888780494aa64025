"""Profiling queries D1-D36 on the train/test search logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expr import dbl
from ..operators import eda
from ..operators import within_search as ws
from ..session import materialize
from ..sources.tables import TRAIN_ONLY_RAW
from .catalog import register, round_doubles, test, train
from .oracle import with_base
from .queries_rows import RAW_COLS
from .queries_within import RELATIVE_COLS, relative_sql
from ..operators.lookups import with_globals
from ..operators.quantiles import exact_quantiles

COMMON = [c for c in RAW_COLS if c not in TRAIN_ONLY_RAW]
CORE_NUMERIC = ["price_usd", "prop_starrating", "prop_review_score", "prop_location_score1", "prop_location_score2",
                "prop_log_historical_price", "promotion_flag", "srch_length_of_stay", "srch_booking_window",
                "srch_adults_count", "srch_children_count", "srch_room_count", "srch_saturday_night_bool",
                "srch_query_affinity_score", "orig_destination_distance", "visitor_hist_starrating",
                "visitor_hist_adr_usd", "random_bool"]
ID_COLS = ["site_id", "visitor_location_country_id", "prop_country_id", "prop_id", "srch_destination_id"]
RATES_SQL = ("count(*) AS rows, avg(CAST(click_bool AS DOUBLE)) AS click_rate, avg(CAST(booking_bool AS DOUBLE)) AS booking_rate, "
             "avg(CAST(relevance AS DOUBLE)) AS relevance_mean")
TRAIN_RAW = "trr AS (SELECT * EXCLUDE (row_id, relevance, dcg_gain) FROM train)"
TEST_RAW = "ter AS (SELECT * EXCLUDE (row_id) FROM test)"


def _raw_train(spark, sf):
    return train(spark, sf)


@register("d1_schema_summary", with_base(select=(
    f"SELECT 'train' AS split, count(*) AS rows, CAST({len(RAW_COLS)} AS BIGINT) AS columns, count(DISTINCT srch_id) AS unique_srch_id, "
    "count(DISTINCT prop_id) AS unique_prop_id, min(date_time) AS min_date, max(date_time) AS max_date FROM train UNION ALL "
    f"SELECT 'test', count(*), CAST({len(COMMON)} AS BIGINT), count(DISTINCT srch_id), count(DISTINCT prop_id), min(date_time), "
    "max(date_time) FROM test")))
def d1_schema_summary(spark, sf):
    parts = []
    for name, df, ncols in (("train", train(spark, sf), len(RAW_COLS)), ("test", test(spark, sf), len(COMMON))):
        parts.append(df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"), F.lit(ncols).cast("long").alias("columns"),
                            F.countDistinct("srch_id").alias("unique_srch_id"), F.countDistinct("prop_id").alias("unique_prop_id"),
                            F.min("date_time").alias("min_date"), F.max("date_time").alias("max_date")))
    return parts[0].unionByName(parts[1])


def _null_sql(src, cols, alias):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS DOUBLE)) * 100 AS {alias} FROM {src}" for c in cols)


@register("d3_null_pct_table", with_base(
    f"a AS ({_null_sql('train', RAW_COLS, 'train_null_pct')})", f"b AS ({_null_sql('test', COMMON, 'test_null_pct')})",
    select="SELECT a.column_name, round(a.train_null_pct, 6) AS train_null_pct, round(b.test_null_pct, 6) AS test_null_pct, "
           "b.column_name IS NOT NULL AS present_in_test FROM a LEFT JOIN b USING (column_name)"))
def d3_null_pct_table(spark, sf):
    a = eda.unpivot(eda.null_pct(train(spark, sf), RAW_COLS, "a_"), RAW_COLS, {"train_null_pct": "a_{}"})
    b = eda.unpivot(eda.null_pct(test(spark, sf), COMMON, "b_"), COMMON, {"test_null_pct": "b_{}"})
    out = a.join(b, "column_name", "left").withColumn("present_in_test", F.col("test_null_pct").isNotNull())
    return round_doubles(out)


@register("d4_label_summary", with_base(select=(
    "SELECT * FROM (SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM train UNION ALL "
    "SELECT 'clicked rows', CAST(sum(click_bool) AS DOUBLE) FROM train UNION ALL SELECT 'booked rows', CAST(sum(booking_bool) AS DOUBLE) FROM train UNION ALL "
    "SELECT 'clicked-only rows', CAST(sum(CASE WHEN click_bool = 1 AND booking_bool = 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM train UNION ALL "
    "SELECT 'non-relevant rows', CAST(sum(CASE WHEN relevance = 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM train UNION ALL "
    "SELECT 'click rate', round(avg(click_bool), 6) FROM train UNION ALL SELECT 'booking rate', round(avg(booking_bool), 6) FROM train UNION ALL "
    "SELECT 'relevance mean', round(avg(relevance), 6) FROM train)")))
def d4_label_summary(spark, sf):
    t = train(spark, sf)
    one = t.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.sum("click_bool").cast("double").alias("clicked rows"),
                F.sum("booking_bool").cast("double").alias("booked rows"),
                F.sum(((F.col("click_bool") == 1) & (F.col("booking_bool") == 0)).cast("int")).cast("double").alias("clicked-only rows"),
                F.sum((F.col("relevance") == 0).cast("int")).cast("double").alias("non-relevant rows"),
                F.avg(dbl("click_bool")).alias("click rate"), F.avg(dbl("booking_bool")).alias("booking rate"),
                F.avg(dbl("relevance")).alias("relevance mean"))
    names = ["rows", "clicked rows", "booked rows", "clicked-only rows", "non-relevant rows", "click rate", "booking rate", "relevance mean"]
    return round_doubles(eda.unpivot(one, names, {"value": "{}"}, key="metric"))


@register("d5_relevance_counts", with_base(select=(
    "SELECT CAST(relevance AS BIGINT) AS relevance, count(*) AS rows, round(count(*) * 100.0 / (SELECT count(*) FROM train), 6) AS row_pct "
    "FROM train GROUP BY relevance")))
def d5_relevance_counts(spark, sf):
    t = train(spark, sf)
    out = t.groupBy("relevance").agg(F.count(F.lit(1)).alias("rows"))
    # the total of a row per label (three at most), not a second pass over the log
    n = F.sum("rows").over(Window.partitionBy())
    return round_doubles(out.select("relevance", "rows", (F.col("rows") * 100.0 / n).alias("row_pct")))


_D6 = ("sl AS (SELECT srch_id, count(*) AS candidates, sum(click_bool) AS clicks, sum(booking_bool) AS bookings, "
       "max(relevance) AS max_relevance, max(random_bool) AS random_bool FROM train GROUP BY srch_id)")


@register("d6_search_labels", with_base(_D6, select=(
    "SELECT srch_id, candidates, CAST(clicks AS BIGINT) AS clicks, CAST(bookings AS BIGINT) AS bookings, "
    "CAST(max_relevance AS BIGINT) AS max_relevance, CAST(random_bool AS BIGINT) AS random_bool, "
    "CAST(clicks - bookings AS BIGINT) AS clicked_no_booking, CAST(clicks > 0 AS BIGINT) AS has_click, "
    "CAST(bookings > 0 AS BIGINT) AS has_booking, CAST(max_relevance > 0 AS BIGINT) AS has_any_relevance FROM sl")))
def d6_search_labels(spark, sf):
    return round_doubles(eda.search_labels(train(spark, sf)))


@register("d7_query_summary", with_base(_D6, select=(
    "SELECT * FROM (SELECT 'searches' AS metric, CAST(count(*) AS DOUBLE) AS value FROM sl UNION ALL "
    "SELECT 'median candidates/search', CAST(median(candidates) AS DOUBLE) FROM sl UNION ALL "
    "SELECT 'mean candidates/search', round(avg(candidates), 6) FROM sl UNION ALL SELECT 'max candidates/search', CAST(max(candidates) AS DOUBLE) FROM sl UNION ALL "
    "SELECT 'searches with any click', CAST(sum(CASE WHEN clicks > 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM sl UNION ALL "
    "SELECT 'searches with booking', CAST(sum(CASE WHEN bookings > 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM sl UNION ALL "
    "SELECT 'searches with no positive label', CAST(sum(CASE WHEN max_relevance = 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM sl UNION ALL "
    "SELECT 'randomized searches pct', round(avg(random_bool), 6) FROM sl)")))
def d7_query_summary(spark, sf):
    sl = eda.search_labels(train(spark, sf))
    one = sl.agg(F.count(F.lit(1)).cast("double").alias("searches"), F.median(dbl("candidates")).alias("median candidates/search"),
                 F.avg(dbl("candidates")).alias("mean candidates/search"), F.max("candidates").cast("double").alias("max candidates/search"),
                 F.sum("has_click").cast("double").alias("searches with any click"),
                 F.sum("has_booking").cast("double").alias("searches with booking"),
                 F.sum(1 - F.col("has_any_relevance")).cast("double").alias("searches with no positive label"),
                 F.avg(dbl("random_bool")).alias("randomized searches pct"))
    return round_doubles(eda.unpivot(one, one.columns, {"value": "{}"}, key="metric"))


def _d8_sql():
    parts = []
    for c in ("candidates", "clicks", "bookings", "clicked_no_booking"):
        x = f"CAST({c} AS DOUBLE)"
        pcts = ", ".join(f"round(quantile_cont({x}, {p}), 6) AS p{int(p * 100)}" for p in eda.DESCRIBE_PCTS)
        parts.append(f"SELECT '{c}' AS column_name, CAST(count({x}) AS DOUBLE) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, "
                     f"min({x}) AS min, max({x}) AS max, {pcts} FROM sl2")
    return with_base(_D6, "sl2 AS (SELECT *, clicks - bookings AS clicked_no_booking FROM sl)", select=" UNION ALL ".join(parts))


@register("d8_describe_search_counts", _d8_sql())
def d8_describe_search_counts(spark, sf):
    out = eda.describe(eda.search_labels(train(spark, sf)), ["candidates", "clicks", "bookings", "clicked_no_booking"])
    return round_doubles(out.withColumn("count", F.col("count").cast("double")))


@register("d9_query_label_patterns", with_base(_D6, select=(
    "SELECT p AS query_label_pattern, count(*) AS searches, round(count(*) / (SELECT count(*) FROM sl), 6) AS pct_searches FROM "
    "(SELECT CASE WHEN bookings > 0 THEN 'has_booking' WHEN clicks > 0 THEN 'click_only' ELSE 'no_positive_label' END AS p FROM sl) GROUP BY p")))
def d9_query_label_patterns(spark, sf):
    sl = eda.search_labels(train(spark, sf))
    n = sl.agg(F.count(F.lit(1)).alias("_n"))
    p = F.when(F.col("bookings") > 0, "has_booking").when(F.col("clicks") > 0, "click_only").otherwise("no_positive_label")
    out = sl.groupBy(p.alias("query_label_pattern")).agg(F.count(F.lit(1)).alias("searches")).transform(lambda _d: with_globals(_d, n))
    return round_doubles(out.select("query_label_pattern", "searches", (F.col("searches") / F.col("_n")).alias("pct_searches")))


@register("d10_candidate_count_distribution", with_base(_D6, select=(
    "SELECT candidates, count(*) AS searches, round(count(*) / (SELECT count(*) FROM sl), 6) AS pct_searches FROM sl GROUP BY candidates")))
def d10_candidate_count_distribution(spark, sf):
    sl = eda.search_labels(train(spark, sf))
    n = sl.agg(F.count(F.lit(1)).alias("_n"))
    out = sl.groupBy("candidates").agg(F.count(F.lit(1)).alias("searches")).transform(lambda _d: with_globals(_d, n))
    return round_doubles(out.select("candidates", "searches", (F.col("searches") / F.col("_n")).alias("pct_searches")))


@register("d11_position_summary", with_base(select=(
    f"SELECT CAST(position AS BIGINT) AS position, {RATES_SQL.replace('AS click_rate', 'AS click_rate_x')}, "
    "avg(CAST(random_bool AS DOUBLE)) AS randomized_pct, count(*) / (SELECT count(*) FROM train) AS row_pct FROM train GROUP BY position")
    .replace("SELECT CAST(position", "SELECT position, rows, round(click_rate_x, 6) AS click_rate, round(booking_rate, 6) AS booking_rate, "
             "round(relevance_mean, 6) AS relevance_mean, round(randomized_pct, 6) AS randomized_pct, round(row_pct, 6) AS row_pct FROM "
             "(SELECT CAST(position", 1) + ")"))
def d11_position_summary(spark, sf):
    t = train(spark, sf)
    n = t.agg(F.count(F.lit(1)).alias("_n"))
    out = t.groupBy("position").agg(*eda.rates(), F.avg(dbl("random_bool")).alias("randomized_pct")).transform(lambda _d: with_globals(_d, n))
    return round_doubles(out.withColumn("row_pct", F.col("rows") / F.col("_n")).drop("_n"))


@register("d12_position_by_random", with_base(select=(
    "SELECT CAST(random_bool AS BIGINT) AS random_bool, CAST(position AS BIGINT) AS position, count(*) AS rows, "
    "round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, "
    "round(avg(CAST(relevance AS DOUBLE)), 6) AS relevance_mean FROM train GROUP BY random_bool, position")))
def d12_position_by_random(spark, sf):
    return round_doubles(train(spark, sf).groupBy("random_bool", "position").agg(*eda.rates()))


@register("d13_missingness_report", with_base(
    f"a AS ({_null_sql('train', COMMON, 'train_missing_pct')})", f"b AS ({_null_sql('test', COMMON, 'test_missing_pct')})",
    select="SELECT column_name, round(train_missing_pct, 6) AS train_missing_pct, round(test_missing_pct, 6) AS test_missing_pct, "
           "round(abs(train_missing_pct - test_missing_pct), 6) AS abs_diff_pct FROM a JOIN b USING (column_name) "
           "ORDER BY abs(train_missing_pct - test_missing_pct) DESC, train_missing_pct DESC, test_missing_pct DESC, column_name LIMIT 80"))
def d13_missingness_report(spark, sf):
    return round_doubles(eda.missingness_report(train(spark, sf), test(spark, sf), COMMON, 80))


def _nulls_expr(cols):
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)


@register("d14_row_missingness", with_base(select=(
    "SELECT split, round(avg(n), 6) AS mean_missing_per_row, round(median(n), 6) AS median_missing_per_row, "
    "round(quantile_cont(n, 0.95), 6) AS p95_missing_per_row FROM ("
    f"SELECT 'train' AS split, CAST({_nulls_expr(COMMON)} AS DOUBLE) AS n FROM train UNION ALL "
    f"SELECT 'test', CAST({_nulls_expr(COMMON)} AS DOUBLE) FROM test) GROUP BY split")))
def d14_row_missingness(spark, sf):
    from ..functions.expr import null_count
    parts = []
    for name, df in (("train", train(spark, sf)), ("test", test(spark, sf))):
        n = null_count(COMMON).cast("double")
        parts.append(df.select(F.lit(name).alias("split"), n.alias("n")))
    u = parts[0].unionByName(parts[1])
    return round_doubles(u.groupBy("split").agg(F.avg("n").alias("mean_missing_per_row"), F.median("n").alias("median_missing_per_row"),
                                                F.percentile("n", 0.95).alias("p95_missing_per_row")))


_FAM = {"rate": [f"comp{i}_rate" for i in range(1, 9)], "inventory": [f"comp{i}_inv" for i in range(1, 9)],
        "rate_percent_diff": [f"comp{i}_rate_percent_diff" for i in range(1, 9)]}


@register("d15_competitor_missingness", with_base(select=" UNION ALL ".join(
    f"SELECT '{k}' AS feature_type, CAST({len(cs)} AS BIGINT) AS columns, "
    f"round((SELECT ({' + '.join(f'avg(CAST({c} IS NULL AS DOUBLE))' for c in cs)}) / {len(cs)} * 100 FROM train), 6) AS train_missing_pct_mean, "
    f"round((SELECT ({' + '.join(f'avg(CAST({c} IS NULL AS DOUBLE))' for c in cs)}) / {len(cs)} * 100 FROM test), 6) AS test_missing_pct_mean"
    for k, cs in _FAM.items())))
def d15_competitor_missingness(spark, sf):
    tr, te = train(spark, sf), test(spark, sf)
    parts = []
    for k, cs in _FAM.items():
        def fam(df):
            s = None
            for c in cs:
                t = F.avg(F.col(c).isNull().cast("double"))
                s = t if s is None else s + t
            return s / len(cs) * 100
        a = tr.agg(fam(tr).alias("train_missing_pct_mean"))
        b = te.agg(fam(te).alias("test_missing_pct_mean"))
        parts.append(with_globals(a, b).select(F.lit(k).alias("feature_type"), F.lit(len(cs)).cast("long").alias("columns"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out)


def _cnt(cond):
    return " + ".join(f"CAST(coalesce(comp{i}_rate {cond}, false) AS INTEGER)" for i in range(1, 9))


@register("d16_competitor_price_position", with_base(select=(
    f"SELECT kind, CAST(n AS BIGINT) AS n_competitors, count(*) AS rows, round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, "
    "round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, round(avg(CAST(relevance AS DOUBLE)), 6) AS relevance_mean FROM ("
    f"SELECT 'lower_rate' AS kind, {_cnt('< 0')} AS n, click_bool, booking_bool, relevance FROM train UNION ALL "
    f"SELECT 'higher_rate', {_cnt('> 0')}, click_bool, booking_bool, relevance FROM train) GROUP BY kind, n")))
def d16_competitor_price_position(spark, sf):
    from ..functions.expr import count_true
    t = train(spark, sf)
    parts = []
    for kind, sign in (("lower_rate", -1), ("higher_rate", 1)):
        n = count_true((F.col(f"comp{i}_rate") < 0) if sign < 0 else (F.col(f"comp{i}_rate") > 0) for i in range(1, 9))
        parts.append(t.select(F.lit(kind).alias("kind"), n.alias("n_competitors"), "click_bool", "booking_bool", "relevance"))
    u = parts[0].unionByName(parts[1])
    return round_doubles(u.groupBy("kind", "n_competitors").agg(*eda.rates()))


def _d17_sql():
    parts = []
    for c in ID_COLS:
        parts.append(
            f"SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM train) AS train_unique, (SELECT count(DISTINCT {c}) FROM test) AS test_unique, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM test WHERE {c} IS NOT NULL EXCEPT SELECT DISTINCT {c} FROM train)) AS test_unseen_in_train, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL EXCEPT SELECT DISTINCT {c} FROM test)) AS train_absent_in_test")
    return with_base(f"cov AS ({' UNION ALL '.join(parts)})", select=(
        "SELECT column_name, train_unique, test_unique, test_unseen_in_train, round(test_unseen_in_train / greatest(test_unique, 1), 6) AS test_unseen_pct, "
        "train_absent_in_test FROM cov"))


@register("d17_u3_id_coverage", _d17_sql())
def d17_u3_id_coverage(spark, sf):
    tr, te = train(spark, sf), test(spark, sf)
    out = None
    for c in ID_COLS:
        a = tr.select(c).filter(F.col(c).isNotNull()).distinct()
        b = te.select(c).filter(F.col(c).isNotNull()).distinct()
        stats = [b.agg(F.count(F.lit(1)).alias("test_unique")),
                 b.join(a, c, "left_anti").agg(F.count(F.lit(1)).alias("test_unseen_in_train")),
                 a.join(b, c, "left_anti").agg(F.count(F.lit(1)).alias("train_absent_in_test"))]
        row = a.agg(F.count(F.lit(1)).alias("train_unique"))
        for st in stats:
            row = with_globals(row, st)
        row = row.select(F.lit(c).alias("column_name"), "*",
                         (F.col("test_unseen_in_train") / F.greatest(F.col("test_unique"), F.lit(1))).alias("test_unseen_pct"))
        out = row if out is None else out.unionByName(row)
    return round_doubles(out)


@register("d18_cardinality", with_base(select=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM train) AS train_unique, (SELECT count(DISTINCT {c}) FROM test) AS test_unique"
    for c in COMMON)))
def d18_cardinality(spark, sf):
    a = eda.distinct_counts(train(spark, sf), COMMON, "train_unique")
    b = eda.distinct_counts(test(spark, sf), COMMON, "test_unique")
    return a.join(b, "column_name")


_QS = [0.00, 0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99, 1.00]


def _d19_sql():
    parts = []
    for split in ("train", "test"):
        for c in CORE_NUMERIC:
            x = f"CAST({c} AS DOUBLE)"
            qs = ", ".join(f"round(quantile_cont({x}, {q}), 6) AS q{int(q * 100):02d}" for q in _QS)
            parts.append(f"SELECT '{split}' AS split, '{c}' AS column_name, {qs}, round(avg({x}), 6) AS mean, "
                         f"round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 6) AS missing_pct FROM {split}")
    return with_base(select=" UNION ALL ".join(parts))


@register("d19_numeric_summary", _d19_sql())
def d19_numeric_summary(spark, sf):
    out = None
    for split, df in (("train", train(spark, sf)), ("test", test(spark, sf))):
        one = df.agg(*[e for c in CORE_NUMERIC for e in (F.avg(dbl(c)).alias(f"m_{c}"), (F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"n_{c}"))])
        one = with_globals(one, exact_quantiles(df, {f"p_{c}": F.col(c) for c in CORE_NUMERIC}, {f"p_{c}": _QS for c in CORE_NUMERIC}))
        flat = one.select(*[F.get(f"p_{c}", F.lit(i)).alias(f"q{int(q * 100):02d}_{c}") for c in CORE_NUMERIC for i, q in enumerate(_QS)],
                          *[F.col(f"m_{c}") for c in CORE_NUMERIC], *[F.col(f"n_{c}") for c in CORE_NUMERIC])
        spec = {f"q{int(q * 100):02d}": f"q{int(q * 100):02d}_{{}}" for q in _QS}
        spec.update({"mean": "m_{}", "missing_pct": "n_{}"})
        part = eda.unpivot(flat, CORE_NUMERIC, spec).select(F.lit(split).alias("split"), "*")
        out = part if out is None else out.unionByName(part)
    return round_doubles(out)


def _d20_sql():
    parts = []
    for c in CORE_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, (SELECT avg({x}) FROM train) AS tm, (SELECT avg({x}) FROM test) AS em, "
                     f"(SELECT stddev_samp({x}) FROM train) AS ts, (SELECT stddev_samp({x}) FROM test) AS es, "
                     f"(SELECT avg(CAST({c} IS NULL AS DOUBLE)) FROM train) AS tn, (SELECT avg(CAST({c} IS NULL AS DOUBLE)) FROM test) AS en")
    return with_base(f"d AS ({' UNION ALL '.join(parts)})", select=(
        "SELECT column_name, round(tm, 6) AS train_mean, round(em, 6) AS test_mean, round(em - tm, 6) AS mean_diff, "
        "round(CASE WHEN sqrt((ts * ts + es * es) / 2) > 0 THEN (em - tm) / sqrt((ts * ts + es * es) / 2) END, 6) AS standardized_mean_diff, "
        "round(tn * 100, 6) AS train_missing_pct, round(en * 100, 6) AS test_missing_pct, round((en - tn) * 100, 6) AS missing_diff_pct FROM d"))


@register("d20_numeric_drift", _d20_sql())
def d20_numeric_drift(spark, sf):
    return round_doubles(eda.numeric_drift_report(train(spark, sf), test(spark, sf), CORE_NUMERIC))


@register("d21_price_quality", with_base(select=" UNION ALL ".join(
    f"SELECT '{s}' AS split, CAST(sum(CASE WHEN price_usd <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive_price_rows, "
    f"CAST(sum(CASE WHEN price_usd > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS price_gt_1000_rows, "
    f"CAST(sum(CASE WHEN price_usd > 5000 THEN 1 ELSE 0 END) AS BIGINT) AS price_gt_5000_rows, "
    f"CAST(sum(CASE WHEN price_usd IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS price_missing_rows FROM {s}" for s in ("train", "test"))))
def d21_price_quality(spark, sf):
    out = None
    for s, df in (("train", train(spark, sf)), ("test", test(spark, sf))):
        p = F.col("price_usd")
        part = df.agg(F.lit(s).alias("split"), F.sum((p <= 0).cast("long")).alias("non_positive_price_rows"),
                      F.sum((p > 1000).cast("long")).alias("price_gt_1000_rows"),
                      F.sum((p > 5000).cast("long")).alias("price_gt_5000_rows"),
                      F.sum(p.isNull().cast("long")).alias("price_missing_rows"))
        out = part if out is None else out.unionByName(part)
    return round_doubles(out.fillna(0))


_D22_COLS = ["srch_id", "prop_id", "price_usd", "prop_starrating", "prop_review_score", "click_bool", "booking_bool", "position"]


@register("d22_o3_top_prices", with_base(select=(
    "SELECT row_id, srch_id, prop_id, round(price_usd, 6) AS price_usd, CAST(prop_starrating AS BIGINT) AS prop_starrating, "
    "round(prop_review_score, 6) AS prop_review_score, CAST(click_bool AS BIGINT) AS click_bool, CAST(booking_bool AS BIGINT) AS booking_bool, "
    "CAST(position AS BIGINT) AS position FROM train ORDER BY price_usd DESC, row_id LIMIT 20")))
def d22_o3_top_prices(spark, sf):
    out = train(spark, sf).orderBy(F.col("price_usd").desc(), F.col("row_id")).limit(20)
    return round_doubles(out.select("row_id", *_D22_COLS))


@register("d23_intent_columns", with_base(select=" UNION ALL ".join(
    f"SELECT '{split}' AS split, row_id, CAST(month(date_time) AS BIGINT) AS search_month, CAST(isodow(date_time) - 1 AS BIGINT) AS search_dow, "
    "CAST(hour(date_time) AS BIGINT) AS search_hour, CAST(srch_adults_count + srch_children_count AS BIGINT) AS party_size, "
    f"round(srch_room_count / NULLIF(CAST(srch_adults_count + srch_children_count AS DOUBLE), 0), 6) AS rooms_per_person FROM {split}"
    for split in ("train", "test"))))
def d23_intent_columns(spark, sf):
    party = F.col("srch_adults_count") + F.col("srch_children_count")
    out = [d.select(F.lit(split).alias("split"), "row_id", F.month("date_time").alias("search_month"), F.weekday("date_time").alias("search_dow"),
                    F.hour("date_time").alias("search_hour"), party.alias("party_size"),
                    F.try_divide(dbl("srch_room_count"), F.when(party != 0, party).cast("double")).alias("rooms_per_person"))
           for split, d in (("train", train(spark, sf)), ("test", test(spark, sf)))]
    return round_doubles(out[0].unionByName(out[1]))


_SEG = {"search_month": "month(date_time)", "search_dow": "isodow(date_time) - 1", "search_hour": "hour(date_time)",
        "srch_length_of_stay": "srch_length_of_stay", "srch_booking_window": "srch_booking_window",
        "party_size": "srch_adults_count + srch_children_count", "srch_room_count": "srch_room_count",
        "srch_saturday_night_bool": "srch_saturday_night_bool"}


@register("d24_target_by_segment", with_base(select=(
    "SELECT segment_col, value, count(*) AS rows, round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, "
    "round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, round(avg(CAST(relevance AS DOUBLE)), 6) AS relevance_mean, "
    "round(count(*) / (SELECT count(*) FROM train), 6) AS row_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{k}' AS segment_col, CAST({e} AS BIGINT) AS value, click_bool, booking_bool, relevance FROM train" for k, e in _SEG.items())
    + ") GROUP BY segment_col, value")))
def d24_target_by_segment(spark, sf):
    t = train(spark, sf)
    exprs = {"search_month": F.month("date_time"), "search_dow": F.weekday("date_time"), "search_hour": F.hour("date_time"),
             "srch_length_of_stay": F.col("srch_length_of_stay"), "srch_booking_window": F.col("srch_booking_window"),
             "party_size": F.col("srch_adults_count") + F.col("srch_children_count"), "srch_room_count": F.col("srch_room_count"),
             "srch_saturday_night_bool": F.col("srch_saturday_night_bool")}
    # one pass: unpivot the 8 segment columns with stack, then one aggregate
    wide = t.select("click_bool", "booking_bool", "relevance", *[e.cast("long").alias(k) for k, e in exprs.items()])
    stack = "stack(8, " + ", ".join(f"'{k}', `{k}`" for k in exprs) + ") AS (segment_col, value)"
    long_ = wide.selectExpr("click_bool", "booking_bool", "relevance", stack)
    n = t.agg(F.count(F.lit(1)).alias("_n"))
    out = long_.groupBy("segment_col", "value").agg(*eda.rates()).transform(lambda _d: with_globals(_d, n))
    return round_doubles(out.withColumn("row_pct", F.col("rows") / F.col("_n")).drop("_n"))


_D26_FEATS = ["price_usd_rank_pct_asc", "price_usd_diff_median", "prop_starrating_rank_pct_desc", "prop_review_score_rank_pct_desc",
              "prop_location_score1_rank_pct_desc", "value_star_per_log_price", "value_review_per_log_price"]


def _bucket_ctes(i, source, feature):
    """Decile buckets (lo, hi], duplicate edges dropped, as ``b{i}``; values by way of 9 digits, so that summation noise moves no row."""
    x = f"round(CAST({feature} AS DECIMAL(38,12)), 9)"
    qs = ", ".join(str(j / 10) for j in range(11))
    return [f"v{i} AS (SELECT *, CAST({x} AS DOUBLE) AS bx FROM {source})",
            f"e{i} AS (SELECT list_sort(list_distinct(quantile_cont(bx, [{qs}]))) AS e FROM v{i})",
            f"b{i} AS (SELECT t.*, greatest(1, len(list_filter(e{i}.e, lambda v: v < bx))) AS b, e{i}.e AS edges "
            f"FROM v{i} t CROSS JOIN e{i} WHERE bx IS NOT NULL AND len(e{i}.e) >= 2)"]


_LABEL_AVGS = ("count(*) AS rows, round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, "
               "round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, round(avg(CAST(relevance AS DOUBLE)), 6) AS relevance_mean")


def _d26_sql():
    exprs = relative_sql()
    ctes = ["rel AS (SELECT *, " + ", ".join(f"{exprs[f]} AS {f}" for f in _D26_FEATS) + " FROM train)"]
    parts = []
    for i, f in enumerate(_D26_FEATS):
        ctes += _bucket_ctes(i, "rel", f)
        parts.append(f"SELECT '{f}' AS feature, CAST(b AS BIGINT) AS bucket, round(any_value(list_extract(edges, b)), 6) AS bucket_lo, "
                     f"round(any_value(list_extract(edges, b + 1)), 6) AS bucket_hi, {_LABEL_AVGS}, "
                     f"round(count(*) / (SELECT count(*) FROM train), 6) AS row_pct FROM b{i} GROUP BY b")
    return with_base(*ctes, select=" UNION ALL ".join(parts))


@register("d26_target_by_quantile", _d26_sql())
def d26_target_by_quantile(spark, sf):
    t = ws.relative_diagnostics(train(spark, sf), RELATIVE_COLS)
    t = materialize(t.select("click_bool", "booking_bool", "relevance",
                             *[F.round(F.col(f).try_cast("decimal(38,12)"), 9).cast("double").alias(f) for f in _D26_FEATS]), "relative")
    out, edges = None, eda.quantile_edges(t, _D26_FEATS)
    for f in _D26_FEATS:
        part = eda.target_by_quantile(t, f, edges=edges)
        out = part if out is None else out.unionByName(part)
    return round_doubles(out)


# ---- D30 smoothed popularity of an item against its labels --------------------------
_D30_MIN, _D30_PRIOR = 20, 100


@register("d30_popularity_deciles", with_base(
    f"pp AS (SELECT prop_id, count(*) AS n, avg(CAST(relevance AS DOUBLE)) AS m FROM train GROUP BY prop_id HAVING count(*) >= {_D30_MIN})",
    f"dg AS (SELECT t.relevance, t.click_bool, t.booking_bool, pp.n, (pp.m * pp.n + (SELECT avg(CAST(relevance AS DOUBLE)) FROM train) * {_D30_PRIOR}) "
    f"/ (pp.n + {_D30_PRIOR}) AS smoothed FROM train t LEFT JOIN pp USING (prop_id))",
    *_bucket_ctes(0, "dg", "smoothed"),
    select=f"SELECT CAST(b AS BIGINT) AS bucket, {_LABEL_AVGS}, round(CAST(median(n) AS DOUBLE), 6) AS median_prop_rows FROM b0 GROUP BY b"))
def d30_popularity_deciles(spark, sf):
    """Items with few rows have no score and so no bucket, as in a left join followed by quantile cuts."""
    t = train(spark, sf)
    table = t.groupBy("prop_id").agg(F.count(F.lit(1)).alias("_n"), F.avg(dbl("relevance")).alias("_m")).filter(F.col("_n") >= _D30_MIN)
    scored = with_globals(t.join(table, "prop_id", "left"), t.agg(F.avg(dbl("relevance")).alias("_g")))
    smoothed = (F.col("_m") * F.col("_n") + F.col("_g") * _D30_PRIOR) / (F.col("_n") + _D30_PRIOR)
    d = materialize(scored.select("click_bool", "booking_bool", "relevance", F.col("_n").alias("n"),
                                  F.round(smoothed.try_cast("decimal(38,12)"), 9).cast("double").alias("smoothed")), "popularity")
    return round_doubles(eda.target_by_quantile(d, "smoothed", extra=[F.median("n").alias("median_prop_rows")])
                         .select("bucket", "rows", "click_rate", "booking_rate", "relevance_mean", "median_prop_rows"))


@register("d27_target_by_promotion", with_base(select=(
    "SELECT CAST(promotion_flag AS BIGINT) AS promotion_flag, count(*) AS rows, round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, "
    "round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, round(avg(CAST(relevance AS DOUBLE)), 6) AS relevance_mean "
    "FROM train GROUP BY promotion_flag")))
def d27_target_by_promotion(spark, sf):
    return round_doubles(train(spark, sf).groupBy("promotion_flag").agg(*eda.rates()))


_D28 = [("prop", ["prop_id"], 100), ("dest", ["srch_destination_id"], 500), ("prop_dest", ["prop_id", "srch_destination_id"], 30)]


def _d28_sql():
    parts = []
    for name, keys, mn in _D28:
        k1 = keys[0]
        k2 = keys[1] if len(keys) > 1 else "NULL"
        parts.append(
            f"SELECT * FROM (SELECT '{name}' AS key_type, CAST({k1} AS BIGINT) AS key1, CAST({k2} AS BIGINT) AS key2, count(*) AS rows, "
            "count(DISTINCT srch_id) AS searches, round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate, "
            "round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, avg(CAST(relevance AS DOUBLE)) AS rm, "
            "round(avg(CAST(position AS DOUBLE)), 6) AS avg_position, round(avg(price_usd), 6) AS avg_price "
            f"FROM train GROUP BY {', '.join(keys)} HAVING count(*) >= {mn} ORDER BY rm DESC, rows DESC, key1, key2 LIMIT 30)")
    return with_base(select=("SELECT key_type, key1, key2, rows, searches, click_rate, booking_rate, round(rm, 6) AS relevance_mean, "
                             "avg_position, avg_price FROM (" + " UNION ALL ".join(parts) + ")"))


@register("d28_o4_popularity_aggregates", _d28_sql())
def d28_o4_popularity_aggregates(spark, sf):
    t = train(spark, sf)
    out = None
    for name, keys, mn in _D28:
        agg = eda.label_aggregate(t, keys, mn)
        k2 = F.col(keys[1]).cast("long") if len(keys) > 1 else F.lit(None).cast("long")
        part = (agg.select(F.lit(name).alias("key_type"), F.col(keys[0]).cast("long").alias("key1"), k2.alias("key2"),
                           "rows", "searches", "click_rate", "booking_rate", "relevance_mean", "avg_position", "avg_price")
                .orderBy(F.col("relevance_mean").desc(), F.col("rows").desc(), "key1", "key2").limit(30))
        out = part if out is None else out.unionByName(part)
    return round_doubles(out)


def _d29_sql():
    parts = []
    for name, keys, mn in _D28:
        ks = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS key_type, round((SELECT count(*) FROM (SELECT DISTINCT {ks} FROM test INTERSECT "
            f"SELECT {ks} FROM train GROUP BY {ks} HAVING count(*) >= {mn})) / greatest((SELECT count(*) FROM (SELECT DISTINCT {ks} FROM test)), 1), 6) AS coverage")
    return with_base(select=" UNION ALL ".join(parts))


@register("d29_test_key_coverage", _d29_sql())
def d29_test_key_coverage(spark, sf):
    tr, te = train(spark, sf), test(spark, sf)
    out = None
    for name, keys, mn in _D28:
        agg_keys = eda.label_aggregate(tr, keys, mn).select(*keys)
        tk = te.select(*keys).distinct()
        part = (tk.join(agg_keys, keys, "left_semi").agg(F.count(F.lit(1)).alias("_hit"))
                .transform(lambda _d: with_globals(_d, tk.agg(F.count(F.lit(1)).alias("_all"))))
                .select(F.lit(name).alias("key_type"), (F.col("_hit") / F.greatest(F.col("_all"), F.lit(1))).alias("coverage")))
        out = part if out is None else out.unionByName(part)
    return round_doubles(out)


@register("d31_dataset_summary", with_base(select=(
    "SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows, "
    "(SELECT count(DISTINCT srch_id) FROM train) AS train_searches, (SELECT count(DISTINCT srch_id) FROM test) AS test_searches, "
    "(SELECT count(DISTINCT prop_id) FROM train) AS train_properties, (SELECT count(DISTINCT prop_id) FROM test) AS test_properties, "
    "round((SELECT count(*) / count(DISTINCT srch_id) FROM train), 6) AS avg_candidates_per_train_search, "
    "round((SELECT avg(click_bool) FROM train), 6) AS click_rate, round((SELECT avg(booking_bool) FROM train), 6) AS booking_rate")))
def d31_dataset_summary(spark, sf):
    tr, te = train(spark, sf), test(spark, sf)
    a = tr.agg(F.count(F.lit(1)).alias("train_rows"), F.countDistinct("srch_id").alias("train_searches"),
               F.countDistinct("prop_id").alias("train_properties"), F.avg(dbl("click_bool")).alias("click_rate"),
               F.avg(dbl("booking_bool")).alias("booking_rate"))
    b = te.agg(F.count(F.lit(1)).alias("test_rows"), F.countDistinct("srch_id").alias("test_searches"),
               F.countDistinct("prop_id").alias("test_properties"))
    j = with_globals(a, b)
    return round_doubles(j.withColumn("avg_candidates_per_train_search", F.col("train_rows") / F.col("train_searches")))


@register("d32_weekly_booking_rate", with_base(select=(
    "SELECT date_trunc('week', date_time) AS week, count(*) AS rows, round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, "
    "round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate FROM train GROUP BY 1")))
def d32_weekly_booking_rate(spark, sf):
    t = train(spark, sf)
    return round_doubles(t.groupBy(F.date_trunc("week", "date_time").cast("timestamp_ntz").alias("week")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(dbl("booking_bool")).alias("booking_rate"), F.avg(dbl("click_bool")).alias("click_rate")))


def _d33_sql():
    parts = []
    for k in ("srch_destination_id", "visitor_location_country_id"):
        parts.append(
            f"SELECT '{k}' AS key, count(*) AS keys, sum(CASE WHEN r <= ceil(0.1 * n) THEN 1 ELSE 0 END) AS top_keys, "
            f"round(sum(CASE WHEN r <= ceil(0.1 * n) THEN c ELSE 0 END) / sum(c), 6) AS top_share FROM "
            f"(SELECT c, row_number() OVER (ORDER BY c DESC, {k}) AS r, count(*) OVER () AS n FROM "
            f"(SELECT {k}, count(*) AS c FROM train GROUP BY {k}))")
    return with_base(select=" UNION ALL ".join(parts))


@register("d33_market_concentration", _d33_sql())
def d33_market_concentration(spark, sf):
    t = train(spark, sf)
    out = eda.top_share(t, "srch_destination_id").unionByName(eda.top_share(t, "visitor_location_country_id"))
    return round_doubles(out.withColumn("top_keys", F.col("top_keys").cast("long")))


@register("d34_inverse_propensity_weights", with_base(
    "pr AS (SELECT position, count(*) AS rows, avg(CAST(booking_bool AS DOUBLE)) AS booking_rate, avg(CAST(click_bool AS DOUBLE)) AS click_rate "
    "FROM train WHERE random_bool = 1 GROUP BY position)",
    select=("SELECT CAST(position AS BIGINT) AS position, rows, round(booking_rate, 6) AS booking_rate, round(click_rate, 6) AS click_rate, "
            "round(CASE WHEN click_rate > 0 THEN (1 / click_rate) / (SELECT avg(1 / click_rate) FROM pr WHERE click_rate > 0) END, 6) AS ipw FROM pr")))
def d34_inverse_propensity_weights(spark, sf):
    t = train(spark, sf).filter(F.col("random_bool") == 1)
    pr = t.groupBy("position").agg(F.count(F.lit(1)).alias("rows"), F.avg(dbl("booking_bool")).alias("booking_rate"),
                                   F.avg(dbl("click_bool")).alias("click_rate"))
    norm = pr.filter(F.col("click_rate") > 0).agg(F.avg(1.0 / F.col("click_rate")).alias("_m"))
    out = pr.transform(lambda _d: with_globals(_d, norm)).withColumn(
        "ipw", F.when(F.col("click_rate") > 0, (1.0 / F.col("click_rate")) / F.col("_m"))).drop("_m")
    return round_doubles(out)


def _d36_sql():
    p = "PARTITION BY srch_id"
    parts = []
    for f in ("price_usd", "prop_review_score"):
        pct = (f"(rank() OVER ({p} ORDER BY {f} ASC NULLS LAST) + (count(*) OVER ({p}, {f}) - 1) / 2.0) / count({f}) OVER ({p})")
        parts.append(f"SELECT '{f}' AS feature, CASE WHEN {f} IS NOT NULL THEN {pct} END AS pct, booking_bool, click_bool FROM train")
    return with_base(f"x AS ({' UNION ALL '.join(parts)})", select=(
        "SELECT feature, CAST(greatest(1, ceil(pct * 10)) AS BIGINT) AS decile, count(*) AS rows, round(avg(CAST(booking_bool AS DOUBLE)), 6) AS booking_rate, "
        "round(avg(CAST(click_bool AS DOUBLE)), 6) AS click_rate FROM x WHERE pct IS NOT NULL GROUP BY 1, 2"))


@register("d36_rate_by_within_search_quantile", _d36_sql())
def d36_rate_by_within_search_quantile(spark, sf):
    t = train(spark, sf)
    out = None
    for f in ("price_usd", "prop_review_score"):
        part = t.select(F.lit(f).alias("feature"), ws.pct_rank_average(f).alias("pct"), "booking_bool", "click_bool")
        out = part if out is None else out.unionByName(part)
    out = out.filter(F.col("pct").isNotNull()).withColumn("decile", F.greatest(F.lit(1), F.ceil(F.col("pct") * 10)).cast("long"))
    return round_doubles(out.groupBy("feature", "decile").agg(F.count(F.lit(1)).alias("rows"), F.avg(dbl("booking_bool")).alias("booking_rate"),
                                                              F.avg(dbl("click_bool")).alias("click_rate")))
