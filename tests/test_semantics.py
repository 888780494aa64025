"""Hand-made frames for the null/tie/prior semantics."""

import datetime as dt
import math

from pyspark.sql import functions as F

from rankspark.operators import blend, encodings as enc, fitted as ft, folds as fo, metrics
from rankspark.operators import row_features as rf, within_search as ws


def test_ties_nulls_pct_rank(spark):
    rows = [(1, 1, 3.0), (1, 2, 1.0), (1, 3, 1.0), (1, 4, None), (1, 5, 5.0), (1, 6, 3.0), (2, 7, 2.0)]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, x double")
    out = ws.add_within_search_features(df, ["x"]).orderBy("row_id").collect()
    assert [r.x_srch_pct_rank for r in out] == [0.7, 0.3, 0.3, None, 1.0, 0.7, 1.0]
    assert [r.x_srch_rank_asc for r in out] == [3, 1, 1, None, 5, 3, 1]
    assert [r.x_srch_rank_desc for r in out] == [2, 4, 4, None, 1, 2, 1]
    # one-row group: sample std undefined -> z-score 0
    assert out[-1].x_srch_zscore == 0.0


def test_window_and_long_forms_agree(spark):
    rows = [(g, g * 10 + i, float((i * 7) % 5) if i % 4 else None) for g in range(1, 6) for i in range(6)]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, x double")
    long_form = {r.row_id: r.x_srch_pct_rank for r in ws.add_within_search_features(df, ["x"]).collect()}
    window_form = {r.row_id: r.p for r in df.select("row_id", ws.pct_rank_average("x").alias("p")).collect()}
    assert long_form == window_form


def _ndcg(spark, rows):
    df = spark.createDataFrame(rows, "srch_id long, row_id long, relevance int, score double")
    return metrics.mean_ndcg(df, "score").first()["ndcg_at_5"]


def test_ndcg_small(spark):
    assert _ndcg(spark, [(1, 1, 5, 0.9), (1, 2, 1, 0.5), (1, 3, 0, 0.1)]) == 1.0
    assert _ndcg(spark, [(1, 1, 0, 0.9), (1, 2, 0, 0.5)]) == 0.0  # no positive label: 0 (Q8)
    worst = _ndcg(spark, [(1, 1, 0, 0.9), (1, 2, 5, 0.1)])
    assert math.isclose(worst, 31 / math.log2(3) / 31)
    # ties broken by row order
    assert _ndcg(spark, [(1, 1, 5, 0.5), (1, 2, 0, 0.5)]) == 1.0
    assert 0.0 <= _ndcg(spark, [(1, i, i % 3, float(i % 2)) for i in range(10)]) <= 1.0


def test_unseen_keys_get_priors(spark):
    fit = spark.createDataFrame([(1, 10, 5, 31, 1, 1), (1, 10, 0, 0, 0, 0), (2, 11, 1, 1, 0, 1)],
                                "srch_id long, prop_id long, relevance int, dcg_gain int, booking_bool int, click_bool int")
    app = spark.createDataFrame([(3, 10), (3, 99), (3, None)], "srch_id long, prop_id long")
    table, priors = enc.fit_target_encoding_table(fit, "prop_id", "prop", 40.0)
    out = {r.prop_id: r for r in enc.apply_target_encoding(app, "prop_id", "prop", table, priors).collect()}
    prior = 6 / 3
    assert math.isclose(out[99].prop_relevance_te, prior) and out[99].prop_te_log_count == 0.0
    assert math.isclose(out[None].prop_relevance_te, prior)  # null key never matches (T9)
    assert math.isclose(out[10].prop_relevance_te, (5 + prior * 40) / (2 + 40))
    assert math.isclose(out[10].prop_booking_per_click_te, (1 + (1 / 3) / (2 / 3) * 40) / (1 + 40))


def test_zero_std_segments(spark):
    fit = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 7.0)], "site_id long, price_usd double")
    out = ft.add_segment_profiles(fit, [fit], (("site", "site_id"),), ("price_usd",))[0].collect()
    assert all(r.site_price_usd_segment_zscore == 0.0 for r in out)


def test_competitor_all_null(spark):
    cols = ", ".join(f"comp{i}_rate int, comp{i}_inv int, comp{i}_rate_percent_diff double" for i in range(1, 9))
    vals = [None] * 24
    one = list(vals)
    one[2] = 10.0
    df = spark.createDataFrame([tuple(vals), tuple(one)], cols)
    r0, r1 = rf.add_competitor_features(df).collect()
    assert r0.comp_rate_mean is None and r0.comp_pct_std == 0.0 and r0.comp_total_missing_count == 24
    assert r1.comp_pct_mean == 10.0 and r1.comp_pct_std == 0.0 and r1.comp_pct_observed_count == 1


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2012, 12, 31, 23, 0), 3), (dt.datetime(2013, 1, 2, 2, 0), -4), (None, 1)],
                               "date_time timestamp_ntz, srch_booking_window int")
    a, b, c = rf.add_temporal_features(df).collect()
    assert a.search_weekofyear == 1 and a.search_dayofweek == 0 and a.early_night == 1 and a.checkin_month == 1
    assert b.early_night == 1 and b.checkin_dayofweek == 2  # negative window clipped to 0
    assert c.search_month == 0 and c.search_dayofweek == -1 and c.search_hour == -1 and c.early_night == 0


def test_folds_few_groups(spark):
    for n in (1, 2, 3):
        df = spark.createDataFrame([(g, g * 10 + i) for g in range(n) for i in range(2)], "srch_id long, row_id long")
        f = fo.group_folds(df, 5, 7)
        vals = sorted(r.fold for r in f.collect())
        assert vals == ([0] if n == 1 else list(range(n)))


def test_stratified_folds_balanced_and_groups_whole(spark):
    rows = [(g, g * 100 + i, g % 2, (g // 2) % 2, dt.datetime(2013, 1 + g % 3, 1)) for g in range(200) for i in range(3)]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, random_bool int, booking_bool int, date_time timestamp_ntz")
    folds, info = fo.stratified_group_folds(df, 5, 2026)
    assert info["strategy"] == "stratified_group"
    j = fo.attach_folds(df, folds)
    assert j.groupBy("srch_id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    st = fo.query_strata_stats(df).join(folds, "srch_id")
    per = st.groupBy("random_bool", "search_month", "query_has_booking", "fold").count().groupBy(
        "random_bool", "search_month", "query_has_booking").agg((F.max("count") - F.min("count")).alias("d"))
    assert per.agg(F.max("d")).first()[0] <= 1


def test_bucket_edges_right_closed(spark):
    fit = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    specs = [("x", "b", 2)]
    edges = ft.bucket_edges(fit, specs)
    app = spark.createDataFrame([(5.5,), (5.0,), (None,), (0.0,), (11.0,)], "x double")
    got = [r.b for r in ft.apply_buckets(app, specs, edges).collect()]
    assert got == [1, 0, -1, 0, 1]


def test_zero_history_is_missing(spark):
    df = spark.createDataFrame([(0.0, 100.0), (None, 100.0), (5.0, 100.0)], "prop_log_historical_price double, price_usd double")
    out = rf.add_trip_and_value_features(df).collect()
    assert out[0].price_diff_from_historical == 100.0 and out[0].price_ratio_to_historical == 0.0  # Q6
    assert out[1].price_diff_from_historical == 100.0
    clean = df.select(rf.cleaned_missing("prop_log_historical_price").alias("c")).collect()
    assert [r.c for r in clean] == [None, None, 5.0]


def test_oof_encoding_ignores_own_fold_labels(spark):
    base = [(g, g * 10 + i, g % 4, (g + i) % 2) for g in range(40) for i in range(3)]
    def enc_rows(flip):
        rows = [(g, rid, p, (1 - b) if (flip and g % 5 == 0) else b) for g, rid, p, b in base]
        df = spark.createDataFrame(rows, "srch_id long, row_id long, prop_id long, booking_bool int")
        df = df.select("*", F.col("booking_bool").alias("click_bool"), (F.col("booking_bool") * 5).alias("relevance"),
                       (F.col("booking_bool") * 31).alias("dcg_gain"))
        folds = spark.createDataFrame([(g, 0 if g % 5 == 0 else 1 + g % 2) for g in range(40)], "srch_id long, fold int")
        out = enc.add_oof_target_encodings(df, folds, 40.0, (("prop_id", "prop"),))
        return {r.row_id: r.prop_relevance_te for r in out.filter(F.col("srch_id") % 5 == 0).collect()}
    assert enc_rows(False) == enc_rows(True)


def test_weight_grid(spark):
    g = blend.weight_grid(spark, 3, 0.05).collect()
    assert len(g) == 231 and all(r.u1 + r.u2 + r.u3 == 20 for r in g)
    assert [tuple(r)[1:] for r in g[:2]] == [(0, 0, 20), (0, 1, 19)]


def test_position_source_fallback(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "position int, random_bool int")
    assert rf.position_fit_source(df).count() == 2  # no random_bool = 0 rows with a position: all rows (Q3)
    df2 = spark.createDataFrame([(1, 1), (2, 0)], "position int, random_bool int")
    assert [r.position for r in rf.position_fit_source(df2).collect()] == [2]


def test_distinct_counts_of_all_kinds_without_an_expand(spark):
    from rankspark.operators import eda

    day = dt.datetime(2026, 1, 1)
    rows = [(1, 0.0, "a", day, None), (1, -0.0, "b", day, None), (2, float("nan"), "a", day + dt.timedelta(microseconds=1), None), (None, float("nan"), None, None, None)]
    df = spark.createDataFrame(rows, "w long, d double, t string, at timestamp, none int")
    out = eda.distinct_counts(df, df.columns, "n")
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    want = df.agg(*[F.countDistinct(c).alias(c) for c in df.columns]).first().asDict()
    assert {r.column_name: r.n for r in out.collect()} == want == {"w": 2, "d": 2, "t": 2, "at": 2, "none": 0}


def test_within_search_features_are_dealt_once(spark):
    rows = [(1, 1, 3.0, "a", None), (1, 2, 1.0, None, 2.0), (2, 3, None, "c", 4.0), (None, 4, 5.0, "d", 1.0)]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, x double, note string, y double")
    out = ws.add_within_search_features(df, ["x", "y"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {r.row_id: (r.srch_id, r.note, r.y, r.x_srch_max_diff, r.y_srch_rank_asc) for r in out.collect()}
    assert got == {1: (1, "a", None, 0.0, None), 2: (1, None, 2.0, -2.0, 1.0), 3: (2, "c", 4.0, None, 1.0), 4: (None, "d", 1.0, 0.0, 1.0)}


def test_grid_tasks_go_by_rows_times_points(spark, monkeypatch):
    df = spark.range(400).selectExpr("id div 4 as srch_id", "id as row_id", "cast(id % 3 = 0 as int) as relevance", "id * 7 % 11 as a", "id * 5 % 13 as b")
    want = [tuple(r) for r in blend.grid_ndcg(df, ["a", "b"], 0.25).orderBy("wid").collect()]
    monkeypatch.setattr(blend, "GRID_ROWS", 100)
    out = blend.grid_ndcg(df, ["a", "b"], 0.25)
    assert "hashpartitioning(srch_id" in out._jdf.queryExecution().executedPlan().toString() and ", 20), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in out.orderBy("wid").collect()]
    assert [(g[:-1], round(g[-1], 9)) for g in got] == [(w[:-1], round(w[-1], 9)) for w in want]


def test_oof_popularity_reads_the_tables_once(spark):
    from __spark_entry__ import queries

    plan = queries()["e13_fold_metric_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan  # what follows reads stored scores
