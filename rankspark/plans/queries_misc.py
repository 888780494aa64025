"""Sources/sinks (S1-S11), set operations (U1-U2), joins (J3-J5), sorts (O2),
model steps (M1-M10, D35) and the full feature build (A16)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.expr import md5_key
from ..operators import folds as fo, metrics
from ..operators import models as md
from ..sources import sinks
from ..sources.tables import convert_csv_to_parquet, load_dataset, sample_by_groups, search_log
from .catalog import labeled, register, round_doubles, test, train
from ..session import drop_paths, materialize, release_shuffles
from ..specs import RAW_ID_CATEGORICAL_COLS
from .features import common_with_time
from .oracle import with_base
from .workflows import WorkflowConfig, add_aux_position_feature, build_features, fit_predict, prepared, run_oof_experiment, \
    run_validation, run_final, run_multi_split_validation

QUICK = WorkflowConfig(folds=2, models=("ranker", "booking", "click"), weight_step=0.1, feature_set="light",
                       params=md.ModelParams(max_iter=10, max_depth=4))


@register("s1_s4_scan_group_sampling", with_base(
    "sg AS (SELECT srch_id FROM (SELECT DISTINCT srch_id FROM labeled) ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id LIMIT 2000)",
    select="SELECT count(*) AS rows, count(DISTINCT srch_id) AS groups, sum(booking_bool) AS bookings FROM labeled WHERE srch_id IN (SELECT srch_id FROM sg)"))
def s1_s4_scan_group_sampling(spark, sf):
    s = sample_by_groups(labeled(spark, sf), 2000, 2026)
    return round_doubles(s.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("srch_id").alias("groups"),
                               F.sum("booking_bool").alias("bookings")))


@register("s2_s3_csv_to_parquet")
def s2_s3_csv_to_parquet(spark, sf):
    """CSV written from the search log, read back with the typed schema, stored as Parquet.  The CSV is compressed, as its text is
    some ten times the tables, and deleted once its Parquet is there."""
    base = sinks.output_dir(spark, "csv")
    log = search_log(spark, sf).drop("row_id")
    log.withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss")).write.option("header", True) \
        .option("compression", "gzip").csv(f"{base}/raw")
    del log
    release_shuffles(spark)
    stored = convert_csv_to_parquet(spark, f"{base}/raw", f"{base}/parquet").inputFiles()[0].rsplit("/", 1)[0]
    drop_paths(spark, [f"{base}/raw"])
    return load_dataset(spark, stored)


_POP = ("gstat AS (SELECT avg(relevance) AS gm FROM train)",
        "pop AS (SELECT prop_id, (avg(relevance) * count(*) + (SELECT gm FROM gstat) * 100) / (count(*) + 100) AS s FROM train GROUP BY prop_id)",
        "ps AS (SELECT test.*, coalesce(pop.s, (SELECT gm FROM gstat)) AS score FROM test LEFT JOIN pop USING (prop_id))")


@register("s5_o1_submission", with_base(*_POP, select=(
    "SELECT srch_id, prop_id, CAST(row_number() OVER (PARTITION BY srch_id ORDER BY round(score, 9) DESC, row_id) AS BIGINT) AS rank_in_search FROM ps")))
def s5_o1_submission(spark, sf):
    """Popularity-scored test rows written as the ordered submission CSV, read back."""
    scored = metrics.popularity_score(train(spark, sf), test(spark, sf), name="score").withColumn("score", F.round("score", 9))
    path = sinks.output_dir(spark, "submission")
    sinks.write_submission(scored, "score", path)
    ranked = sinks.ranked_submission(scored, "score")
    from pyspark.sql import Window
    w = Window.partitionBy("srch_id").orderBy(F.col("score").desc(), F.col("row_id"))
    return ranked.select("srch_id", "prop_id", F.row_number().over(w).cast("long").alias("rank_in_search"))


@register("s6_s10_prediction_roundtrip")
def s6_s10_prediction_roundtrip(spark, sf):
    scored = metrics.random_score(metrics.popularity_score(train(spark, sf), test(spark, sf), name="pop_score"), 1)
    path = sinks.output_dir(spark, "pred")
    sinks.write_predictions(scored.select("srch_id", "prop_id", "row_id", "pop_score", "random_score"), path)
    return sinks.load_predictions(spark, path, {"srch_id": "bigint", "prop_id": "bigint", "pop_score": "double"})


@register("s7_metrics_sink")
def s7_metrics_sink(spark, sf):
    log = labeled(spark, sf)
    met = metrics.mean_ndcg(metrics.random_score(log, 7), "random_score", name="value").select(
        F.lit("random_ndcg_at_5").alias("metric"), "value")
    path = sinks.output_dir(spark, "metrics")
    sinks.write_metrics(met, {"seed": 7, "k": 5}, path)
    return spark.read.json(f"{path}/metrics")


@register("s8_s9_eda_table_sink")
def s8_s9_eda_table_sink(spark, sf):
    t = train(spark, sf)
    base = sinks.output_dir(spark, "eda")
    pos = t.groupBy("position").agg(F.count(F.lit(1)).alias("rows"), F.avg("booking_bool").alias("booking_rate"))
    top = t.orderBy(F.col("price_usd").desc(), "row_id").select("srch_id", "prop_id", "price_usd", "date_time")
    return sinks.save_eda_table("position_summary", pos, base).unionByName(sinks.save_eda_table("top_prices", top, base, 100))


@register("s11_model_persistence")
def s11_model_persistence(spark, sf):
    from pyspark.ml.regression import GBTRegressionModel
    tr, te = train(spark, sf), test(spark, sf)
    feats = ["price_usd", "prop_starrating", "prop_review_score", "prop_location_score1", "promotion_flag"]
    model = md.fit_regressor(tr, None, feats, F.col("relevance"), md.ModelParams(max_iter=5, max_depth=3))
    path = sinks.output_dir(spark, "model")
    sinks.save_model(model, path)
    loaded = sinks.load_model(GBTRegressionModel, path)
    return md.predict_value(loaded, te, feats, "score").select("row_id", "score")


@register("u1_u2_union_distinct", with_base(select=(
    "SELECT count(*) AS rows, count(DISTINCT srch_id) AS groups, count(DISTINCT prop_id) AS items FROM "
    "(SELECT srch_id, prop_id FROM train UNION ALL SELECT srch_id, prop_id FROM test)")))
def u1_u2_union_distinct(spark, sf):
    u = train(spark, sf).unionByName(test(spark, sf), allowMissingColumns=True)
    return u.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("srch_id").alias("groups"),
                 F.countDistinct("prop_id").alias("items"))


@register("j3_j4_semi_anti_split", with_base(
    "g AS (SELECT DISTINCT srch_id FROM labeled)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), srch_id) AS rn, count(*) OVER () AS n FROM g)",
    "v AS (SELECT srch_id FROM r WHERE rn <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)))",
    select=("SELECT 'train' AS side, count(*) AS rows, count(DISTINCT srch_id) AS groups FROM labeled WHERE srch_id NOT IN (SELECT srch_id FROM v) "
            "UNION ALL SELECT 'valid', count(*), count(DISTINCT srch_id) FROM labeled WHERE srch_id IN (SELECT srch_id FROM v)")))
def j3_j4_semi_anti_split(spark, sf):
    log = labeled(spark, sf)
    fit, valid = fo.make_group_split(log, "random", 0.2, 2026)
    a = fit.agg(F.lit("train").alias("side"), F.count(F.lit(1)).alias("rows"), F.countDistinct("srch_id").alias("groups"))
    b = valid.agg(F.lit("valid").alias("side"), F.count(F.lit(1)).alias("rows"), F.countDistinct("srch_id").alias("groups"))
    return a.unionByName(b)


@register("j5_one_to_one_score_join", with_base(*_POP, select=(
    "SELECT row_id, srch_id, prop_id, round(score, 6) AS pop_score, round(CAST(('0x' || substr(md5(concat(CAST(row_id AS VARCHAR), ':3')), 1, 8)) AS BIGINT) "
    f"/ {float(16 ** 8)}, 6) AS random_score FROM ps")))
def j5_one_to_one_score_join(spark, sf):
    """Two score tables joined on (srch_id, row_id); both sides must be unique on the key."""
    te = test(spark, sf)
    a = metrics.popularity_score(train(spark, sf), te, name="pop_score").select("srch_id", "row_id", "prop_id", "pop_score")
    b = metrics.random_score(te, 3).select("srch_id", "row_id", "random_score")
    for side in (a, b):
        st = side.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("srch_id", "row_id").alias("d")).first()
        if st["n"] != st["d"]:
            raise ValueError("score tables must be one-to-one on (srch_id, row_id)")
    return round_doubles(a.join(b, ["srch_id", "row_id"], "inner"))


@register("o2_a13_stable_group_sort")
def o2_a13_stable_group_sort(spark, sf):
    """Ranker input order: hash-partitioned by query, sorted by (query, row) inside
    partitions; group sizes follow in the same order."""
    t = train(spark, sf).repartition("srch_id").sortWithinPartitions("srch_id", "row_id")
    return fo.group_sizes(t)


# ---- full feature build and models (rows-only checks) ------------------------------
@register("a16_full_feature_build")
def a16_full_feature_build(spark, sf):
    from .features import build_ranking_features
    _, apply, feats, _ = build_ranking_features(train(spark, sf), test(spark, sf))
    return apply.select("row_id", *feats)


def _quick_split(spark, sf):
    """Row and search features are the same on both sides: made and stored once, before the split."""
    log = materialize(common_with_time(labeled(spark, sf)), "common")
    fit, valid = fo.make_group_split(log, "time", 0.2, 2026)
    F_fit, F_val, feats, _ = build_features(fit, valid, QUICK)
    return F_fit, F_val, feats


def _prepared_split(spark, sf):
    """The split as keys, labels and feature vectors, assembled once for all passes of the fits."""
    F_fit, F_val, feats = _quick_split(spark, sf)
    return prepared(F_fit, feats, []), prepared(F_val, feats, []), feats


@register("m1_booking_click_models")
def m1_booking_click_models(spark, sf):
    F_fit, F_val, feats = _prepared_split(spark, sf)
    out = fit_predict(("booking", "click"), F_fit, None, F_val, feats, QUICK)
    return out.select("srch_id", "row_id", "booking_score", "click_score")


@register("m2_aux_position_model")
def m2_aux_position_model(spark, sf):
    F_fit, F_val, feats = _quick_split(spark, sf)
    f2, v2, _ = add_aux_position_feature(F_fit, F_val, feats, QUICK)
    return f2.select("row_id", "aux_position_pred").unionByName(v2.select("row_id", "aux_position_pred"))


@register("m3_m4_rankers")
def m3_m4_rankers(spark, sf):
    F_fit, F_val, feats = _prepared_split(spark, sf)
    out = fit_predict(("ranker", "second_ranker"), F_fit, None, F_val, feats, QUICK)
    return out.select("srch_id", "row_id", "ranker_score", "second_ranker_score")


@register("m5_m6_raw_id_models")
def m5_m6_raw_id_models(spark, sf):
    """The models read ids and labels alone, in many passes: the log is made and stored once, and so are the rows of the fit."""
    need = dict.fromkeys(("srch_id", "row_id", "date_time", *RAW_ID_CATEGORICAL_COLS, "booking_bool", "dcg_gain"))
    fit, valid = fo.make_group_split(materialize(labeled(spark, sf).select(*need), "ids"), "time", 0.2, 2026)
    fit = materialize(fit, "fit")
    out = fit_predict(("raw_id_booking", "raw_id_ranker"), fit, None, valid, [], QUICK)
    return out.select("srch_id", "row_id", "raw_id_booking_score", "raw_id_ranker_score")


@register("m7_m9_oof_workflow")
def m7_m9_oof_workflow(spark, sf):
    res = run_oof_experiment(train(spark, sf), test(spark, sf), replace(QUICK, use_meta_ranker=True))
    scores = res["test_scores"].agg(F.count("final_score").cast("double").alias("value"))
    return res["metrics"].unionByName(scores.select(F.lit("test_scores").alias("metric"), "value"))


@register("m10_v7_holdout_validation")
def m10_v7_holdout_validation(spark, sf):
    """All three strategies, then the refit with the primary one's best iteration; the rows of its submission join the metrics."""
    tr = materialize(common_with_time(train(spark, sf)), "train")
    out, best = run_multi_split_validation(tr, QUICK)
    path = sinks.output_dir(spark, "final")
    scored = run_final(tr, test(spark, sf), QUICK, best, path)
    n = scored.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("final").alias("split_strategy"), F.lit(False).alias("is_primary"), F.lit("test_rows").alias("metric"), "value")
    return out.unionByName(n)


@register("d35_importance_by_family")
def d35_importance_by_family(spark, sf):
    F_fit, _, feats = _quick_split(spark, sf)
    model = md.fit_classifier(prepared(F_fit, feats, []), None, feats, "booking_bool", QUICK.params)
    return md.importance_by_family(model, feats, spark)
