"""LambdaRank gradients and models, key lookups in long form, fits submitted together."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankspark.operators import encodings as enc
from rankspark.operators import fitted as ft
from rankspark.operators import lambdarank as lr
from rankspark.operators import metrics
from rankspark.operators import models as md
from rankspark.plans.workflows import together


def brute_lambdas(rows, truncation):
    """rows: (row_id, score, gain) of one search."""
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    ideal = sum(g / math.log2(i + 2) for i, g in enumerate(sorted((r[2] for r in rows), reverse=True)[:truncation]))
    out = {r[0]: [0.0, 0.0] for r in rows}
    for i, (a, sa, ga) in enumerate(order):
        for j in range(i + 1, len(order)):
            b, sb, gb = order[j]
            if i >= truncation or ga == gb or not ideal:
                continue
            w = abs((ga - gb) * (1 / math.log2(i + 2) - 1 / math.log2(j + 2))) / ideal
            sign = 1 if ga > gb else -1
            p = 1 / (1 + math.exp(sign * (sa - sb)))
            for k, s in ((a, sign), (b, -sign)):
                out[k][0] += s * p * w
                out[k][1] += p * (1 - p) * w
    return out


@pytest.mark.parametrize("truncation", [1, 3, 8])
def test_gradients_against_all_pairs(spark, truncation):
    rng = random.Random(truncation)
    rows = [(s, s * 100 + i, rng.choice([0.0, 0.5, rng.random()]), rng.choice([0.0, 0.0, 1.0, 31.0])) for s in range(12) for i in range(rng.randint(1, 15))]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, _score double, _gain double")
    got = lr.with_lambdas(df.join(lr._ideal(df, "_gain", "srch_id", truncation), "srch_id"), truncation=truncation)
    want = {}
    for s in range(12):
        want.update(brute_lambdas([r[1:] for r in rows if r[0] == s], truncation))
    found = {r.row_id: (r._g, r._h) for r in got.collect()}
    assert found.keys() == want.keys()
    for k, (g, h) in want.items():
        assert math.isclose(found[k][0], g, abs_tol=1e-12) and math.isclose(found[k][1], h, abs_tol=1e-12)


def planted(spark, searches, seed):
    """A row's label follows its ``x`` against the search's others; the search's level in ``x`` and the label rate mislead a pointwise fit."""
    rng = random.Random(seed)
    rows = []
    for s in range(searches):
        level, own = rng.uniform(-5, 5), [rng.gauss(0, 1) for _ in range(10)]
        best = max(range(10), key=lambda i: own[i] + rng.gauss(0, 0.1))
        many = level < 0
        for i, x in enumerate(own):
            rel = 5 if i == best else 1 if many and rng.random() < 0.6 else 0
            rows.append((seed * 10 ** 6 + s, (seed * 10 ** 6 + s) * 100 + i, x, rng.random(), level, rel, float(2 ** rel - 1), s % 7))
    return spark.createDataFrame(rows, "srch_id long, row_id long, x double, noise double, level double, relevance int, dcg_gain double, prop_id long")


def test_ranker_stops_early_saves_and_ranks(spark, tmp_path):
    train, valid, test = planted(spark, 120, 1), planted(spark, 40, 2), planted(spark, 60, 3)
    feats = ["level", "noise", "x"]
    p = md.ModelParams(max_iter=12, max_depth=3, step_size=0.3, min_instances=5)
    model = md.fit_ranker(train, valid, feats, p)
    assert 1 <= model.getNumTrees <= 12
    model.write().overwrite().save(f"{tmp_path}/ranker")
    from pyspark.ml.regression import GBTRegressionModel
    again = GBTRegressionModel.load(f"{tmp_path}/ranker")
    a, b = (md.predict_value(m, test, feats, "score") for m in (model, again))
    assert a.select("row_id", "score").exceptAll(b.select("row_id", "score")).count() == 0
    value = metrics.mean_ndcg(a, "score", name="v").first()[0]
    chance = metrics.mean_ndcg(metrics.random_score(test, 1), "random_score", name="v").first()[0]
    assert value > 0.9 > chance + 0.2
    assert model.featureImportances.toArray().argmax() == 2


def test_ranker_without_any_pair(spark):
    flat = planted(spark, 3, 4).withColumn("dcg_gain", F.lit(0.0))
    model = md.fit_ranker(flat, None, ["x"], md.ModelParams(max_iter=2))
    assert {r.score for r in md.predict_value(model, flat, ["x"], "score").collect()} == {0.0}


def test_raw_id_ranker_learns_ids(spark):
    rng = random.Random(6)
    rows = [(s, s * 100 + i, item, 5 if item == max(own) else 0, 31.0 if item == max(own) else 0.0) for s in range(80)
            for own in [rng.sample(range(30), 6)] for i, item in enumerate(own)]
    df = spark.createDataFrame(rows, "srch_id long, row_id long, prop_id long, relevance int, dcg_gain double")
    model = md.fit_raw_id_ranker(df, num_features=1 << 10)
    out = md.predict_raw_id(model, df, "score", proba=False)
    assert metrics.mean_ndcg(out, "score", name="v").first()[0] > 0.9 and "features" not in out.columns


def test_keys_together_equal_keys_one_by_one(spark):
    rng = random.Random(8)
    rows = [(i, i // 4, rng.choice([1, 2, 3, None]), rng.choice([10, 20, None]), rng.random(), rng.randint(0, 1), rng.randint(1, 9), rng.randint(0, 1)) for i in range(160)]
    df = spark.createDataFrame(rows, "row_id long, srch_id long, a long, b int, price_usd double, booking_bool int, position int, random_bool int") \
        .selectExpr("*", "booking_bool as click_bool", "booking_bool * 5 as relevance", "booking_bool * 31 as dcg_gain", "struct(a, b) as _key_ab")
    fit, apply = df.where("row_id < 120"), df.where("row_id >= 100").withColumn("a", F.expr("if(row_id % 9 = 0, 77, a)"))
    folds = spark.createDataFrame([(g, g % 3) for g in range(40)], "srch_id long, fold int")
    specs = (("a", "a"), ("b", "b"), ("_key_ab", "ab"), ("not_there", "no"))
    steps = {
        "te": lambda sp: enc.add_fit_target_encodings(fit, [apply], 4.0, sp)[0], "te_oof": lambda sp: enc.add_oof_target_encodings(fit, folds, 4.0, sp),
        "pos": lambda sp: enc.add_fit_position_aggregates(fit, [apply], sp)[0], "pos_oof": lambda sp: enc.add_oof_position_aggregates(fit, folds, sp),
        "freq": lambda sp: ft.add_frequency_features(fit, [apply], sp)[0],
        "seg": lambda sp: ft.add_segment_profiles(fit, [apply], tuple((a, k) for k, a in sp), ("price_usd",))[0],
    }
    for name, step in steps.items():
        got = {r.row_id: r for r in step(specs).collect()}
        for spec in specs[:3]:
            one = step((spec,))
            new = [c for c in one.columns if c not in df.columns]
            assert new, name
            rows = one.collect()
            assert len(rows) == len(got)
            for r in rows:
                for c in new:
                    assert (r[c] is None) == (got[r.row_id][c] is None) and (r[c] is None or math.isclose(r[c], got[r.row_id][c], abs_tol=1e-9)), (name, c)


def test_together_keeps_order_and_raises(spark):
    assert together(spark, [lambda i=i: spark.range(i).count() for i in range(5)], 3) == [0, 1, 2, 3, 4]
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1 // 0], 2)


def test_exact_quantiles_equal_percentile(spark):
    from rankspark.operators.quantiles import exact_medians, exact_quantiles

    rng = random.Random(9)
    rows = [(rng.gauss(0, 1), rng.randint(0, 3), None if i % 3 else rng.random(), None) for i in range(1501)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double")
    qs = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.999, 1.0]
    got = exact_quantiles(df, {c: F.col(c) for c in "abcd"}, {c: qs for c in "abcd"}).first()
    want = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(q) for q in qs])).alias(c) for c in "abc"]).first()
    for c in "abc":
        assert all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12) for x, y in zip(got[c], want[c], strict=True))
    assert got.d == []
    med = exact_medians(df, {"m": F.col("a") * 2, "none": F.col("d")}).first()
    assert math.isclose(med.m, 2 * want.a[4]) and med.none is None
    assert exact_medians(df.limit(0), {"m": F.col("a")}).first().m is None


def test_raw_id_models_read_ids_that_are_stored_once(spark, monkeypatch):
    from rankspark.plans import queries_misc

    seen = []
    monkeypatch.setattr(queries_misc, "fit_predict", lambda names, fit, valid, apply, feats, cfg: seen.extend([fit, apply]) or apply.selectExpr(
        "srch_id", "row_id", "0D AS raw_id_booking_score", "0D AS raw_id_ranker_score"))
    out = queries_misc.m5_m6_raw_id_models(spark, "/root/testdata/sf0.001")
    log = queries_misc.labeled(spark, "/root/testdata/sf0.001")
    assert out.count() == seen[1].count() and seen[0].count() + seen[1].count() == log.count()
    for df in seen:
        assert not [f for f in df.inputFiles() if "/testdata/" in f]
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
