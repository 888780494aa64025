"""Row identity, ingest cleaning and searches with more than 100 candidates."""
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rankspark.operators import metrics
from rankspark.operators import within_search as ws
from rankspark.plans.oracle import exact_rounding
from rankspark.sources.tables import load_dataset, read_search_csv, row_identity, with_row_identity


@pytest.fixture(scope="module")
def searches(spark):
    rng = random.Random(3)
    rows = [(s, p, round(rng.uniform(10, 500), 2) if rng.random() > 0.1 else None, rng.randint(0, 5), rng.choice([0, 0, 1, 5]))
            for s, n in ((1, 120), (2, 30), (3, 250), (4, 1)) for p in range(1, n + 1)]
    return spark.createDataFrame(rows, "srch_id long, position int, price_usd double, prop_starrating int, relevance int") \
        .withColumn("row_id", row_identity("srch_id", "position"))


def test_ids_of_long_searches_are_distinct(searches):
    assert searches.select("row_id").distinct().count() == searches.count() == 401


def test_within_search_features_of_long_searches(searches):
    got = ws.add_within_search_features(searches, ["price_usd", "prop_starrating"]).toPandas().sort_values("row_id")
    assert len(got) == 401
    want = searches.toPandas().sort_values("row_id")
    for c in ("price_usd", "prop_starrating"):
        g = want[c].astype(float).groupby(want.srch_id)
        for name, x in (("mean_diff", want[c] - g.transform("mean")), ("median_diff", want[c] - g.transform("median")),
                        ("pct_rank", g.rank(method="average", pct=True)), ("rank_asc", g.rank(method="min")),
                        ("rank_desc", g.rank(method="min", ascending=False))):
            pd.testing.assert_series_equal(got[f"{c}_srch_{name}"], x.astype(float), check_names=False, check_index=False)


def test_ndcg_ties_go_by_row_number(searches):
    flat = searches.withColumn("score", F.lit(0.5))
    top = ws.top_k(flat, [F.col("score").desc(), F.col("row_id")], 3).collect()
    assert sorted((r.srch_id, r.position) for r in top) == [(s, p) for s in (1, 2, 3) for p in (1, 2, 3)] + [(4, 1)]
    assert metrics.dcg_by_group(flat, [F.col("score").desc(), F.col("row_id")], k=5).count() == 4


def test_identity_out_of_range_fails(spark):
    for pair in ((1, 1 << 24), (1 << 38, 1), (1, -1)):
        with pytest.raises(Exception, match="out of range"):
            spark.createDataFrame([pair], "srch_id long, position long").select(row_identity("srch_id", "position")).collect()


def test_loaded_parquet_has_identity_and_no_nan(spark, tmp_path):
    df = spark.createDataFrame([(1, 7, float("nan")), (1, 7, 2.0), (1, 7, 2.0), (2, 8, None)], "srch_id long, prop_id int, price_usd double")
    df.write.parquet(f"{tmp_path}/log")
    out = load_dataset(spark, f"{tmp_path}/log")
    assert out.select("row_id").distinct().count() == 4
    assert out.where(F.isnan("price_usd")).count() == 0 and out.where("price_usd is null").count() == 2
    assert with_row_identity(out).columns == out.columns


def test_csv_nulls_and_values_that_do_not_fit(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("srch_id,prop_id,prop_starrating,price_usd\n5000000000,1,5,NULL\n2,2,,3.5\n")
    rows = read_search_csv(spark, str(good)).orderBy("prop_id").collect()
    assert [tuple(r) for r in rows] == [(5000000000, 1, 5, None), (2, 2, None, 3.5)]
    bad.write_text("srch_id,prop_id,prop_starrating,price_usd\n1,1,300,1.0\n")
    with pytest.raises(Exception):
        read_search_csv(spark, str(bad)).collect()


def test_exact_rounding_rewrites_nested_calls():
    sql = "SELECT round(avg(x), 6) AS a, round(coalesce(round(y, 6), f(z, 2)), 6) AS b, round(q, 9) AS c"
    one = "CAST(round(CAST({} AS DECIMAL(38,10)), 6) AS DOUBLE)"
    assert exact_rounding(sql) == f"SELECT {one.format('avg(x)')} AS a, {one.format('coalesce(' + one.format('y') + ', f(z, 2))')} AS b, round(q, 9) AS c"
