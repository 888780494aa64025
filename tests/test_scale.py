"""What the shared steps shuffle and how many tasks they take."""
import pathlib

from pyspark.sql import functions as F

from rankspark.functions.expr import r6
from rankspark.operators import encodings, fitted, folds, keyed, lookups, row_features
from rankspark.operators.labels import add_relevance
from rankspark.plans import features, queries_misc, workflows
from rankspark.plans.catalog import QUERIES
from rankspark.session import JIT_LIMIT, cut_lineage
from rankspark.sources import tables

SF = "/root/testdata/sf0.001"


def test_lines_are_dealt_as_their_tables_columns(spark, capsys):
    tables.search_log(spark, SF).select("position", "comp8_inv").explain()
    made, dealt = capsys.readouterr().out.split("Window [", 1)
    assert "comp8_inv" in made and "comp8_inv" not in dealt


def test_many_lines_make_more_tasks_and_the_same_rows(spark, monkeypatch):
    usual = tables.search_log(spark, SF).select("row_id", "srch_id", "position", "price_usd", "orig_destination_distance")
    want = sorted(usual.collect())
    monkeypatch.setattr(tables, "TASK_ROWS", 200)
    log = tables.search_log(spark, SF)
    assert sorted(log.select(usual.columns).collect()) == want
    assert log.rdd.getNumPartitions() == -(-len(want) // 200)


def test_lines_of_a_task_are_bounded_with_many_shuffle_partitions(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 200)
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        log = tables.search_log(spark, SF).select("row_id", "position")
        assert log.rdd.getNumPartitions() >= -(-log.count() // 200)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_wide_projections_are_compiled(spark):
    tables.search_log(spark, SF)
    assert spark.conf.get(JIT_LIMIT[0]) == JIT_LIMIT[1]


def test_keys_of_few_and_of_many_values_meet_the_same_tables(spark, monkeypatch):
    log = tables.search_log(spark, SF).select("row_id", "srch_id", "prop_id", "site_id", "srch_destination_id")
    specs = (("prop_id", "prop"), ("site_id", "site"), ("srch_destination_id", "dest"))
    got = []
    for most in (0, 50, 10 ** 6):
        monkeypatch.setattr(keyed, "LOCAL_VALUES", most)
        out = fitted.add_frequency_features(log, [log], specs)[0]
        got.append(sorted(out.select("row_id", *[f"{a}_log_frequency" for _, a in specs]).collect()))
    assert len(got[0]) == log.count() and got[0] == got[1] == got[2]


def test_packed_rows_come_back_as_they_were(spark):
    log = tables.search_log(spark, SF)
    block, unpacked = lookups.packed(log, ["srch_id", "row_id", "prop_id", "click_bool"])
    assert "_packed" in block.columns and "price_usd" not in block.columns and "prop_id" in block.columns
    back = unpacked(block)
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in log.schema}
    assert back.select(log.columns).exceptAll(log).isEmpty() and back.count() == log.count()


def test_light_features_store_the_wide_rows_once(spark, monkeypatch):
    kept = []
    real = workflows.materialize
    monkeypatch.setattr(workflows, "materialize", lambda df, label: kept.append(len(df.columns)) or real(df, label))
    monkeypatch.setattr(workflows, "cut_lineage", lambda df: kept.append(len(df.columns)) or cut_lineage(df))
    log = tables.search_log(spark, SF).transform(add_relevance)
    fit, apply, feats, _ = workflows.build_light_features(log.where("srch_id % 5 <> 0"), log.where("srch_id % 5 = 0"), 2026, 2, 40.0)
    assert sum(n > 100 for n in kept) == 2 and len(feats) > 300
    assert fit.select("prop_log_frequency", "price_usd_srch_zscore").where("prop_log_frequency is null").isEmpty()


def test_time_split_after_the_common_features_goes_by_time(spark):
    log = tables.search_log(spark, SF).transform(add_relevance)
    common = features.common_with_time(log)
    assert "date_time" in common.columns and "date_time" not in features.select_feature_columns(common, common)
    want, got = (folds.split_groups(d, "time", 0.2, 2026).where("is_valid") for d in (log, common))
    assert sorted(got.collect()) == sorted(want.collect())


def test_relevance_counts_read_the_log_once(spark):
    plan = QUERIES["d5_relevance_counts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 6 and "scalar-subquery" not in plan


def test_segments_read_stored_columns(spark):
    plan = QUERIES["e4_segment_ndcg"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_returnflag" not in plan


def test_keys_of_few_values_are_joined_once_beside_keys_of_many(spark, monkeypatch, capsys):
    log = cut_lineage(tables.search_log(spark, SF).select("row_id", "prop_id", F.col("prop_id").alias("item"), "site_id", "prop_country_id", "srch_destination_id"))
    specs = (("prop_id", "prop"), ("item", "item"), ("site_id", "site"), ("prop_country_id", "country"), ("srch_destination_id", "dest"))
    monkeypatch.setattr(keyed, "LOCAL_VALUES", 40)  # all but the items
    monkeypatch.setattr(fitted, "keyed", lambda *a: got.extend(keyed.keyed(*a)) or got)
    got = []
    fitted.add_frequency_features(log, [log], specs)
    got[0].explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("strategy=broadcast") == 3


def test_rounding_as_doubles_is_that_of_decimals(spark):
    values = [0.0, -0.0, 0.5, 1 / 3, -2 / 3, 1e-7, 5e-7, 15e-7, 25e-7, -15e-7, 0.1234565, 0.12345649999, 0.12345650001, 123456.7890125, 999999.9999995, 1e6, -123456789.123456789, 1e15, 1e29,
              float("inf"), float("nan"), None, *[(i * 7919 % 10007) / 997 * (-1) ** i for i in range(500)]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    decimal = F.round(F.col("x").try_cast("decimal(38,10)"), 6).cast("double")
    assert df.where(~r6(F.col("x")).eqNullSafe(decimal)).count() == 0
    assert all(str(v) != "-0.0" for (v,) in df.select(r6(F.col("x"))).collect())


def test_position_tables_of_many_keys_hold_no_values_in_aggregates(spark, monkeypatch, capsys):
    log = cut_lineage(tables.search_log(spark, SF).select("row_id", "srch_id", "prop_id", "site_id", "position", "random_bool"))
    specs = (("prop_id", "prop"), ("site_id", "site"))
    own = folds.group_folds(log, 3, 1)
    monkeypatch.setattr(keyed, "LOCAL_VALUES", 0)
    for out in (encodings.add_oof_position_aggregates(log, own, specs), encodings.add_fit_position_aggregates(log, [log], specs)[0]):
        out.explain("extended")
        optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert "Aggregate [_k#" in optimized
        assert not [x for x in optimized.splitlines() if "Aggregate [_k#" in x and ("percentile(" in x or "median(" in x)]


def test_position_statistics_of_counts_are_those_of_rows(spark):
    rows = [(k, p, f) for k, p, f in zip("aaaaabbbbcddd", [1, 9, 4, 4, 0, 2, 3, 7, 7, 5, 6, 6, 8], [0, 1, 2, 0, 1, 0, 0, 0, 0, 1, 2, 2, 0])]
    df = spark.createDataFrame(rows, "key string, position int, fold int")
    counts = df.groupBy("key", "position").agg(F.count("*").alias("_a"), F.count(F.when(F.col("fold") != 0, 1)).alias("_b"))
    got = {r["key"]: r for r in encodings._counted_stats(counts, ["key"], ["_a", "_b"]).collect()}
    for c, own in (("_a", df), ("_b", df.where("fold <> 0"))):
        want = {r["key"]: r for r in own.groupBy("key").agg(*encodings._pos_aggs("x")).collect()}
        for key in "abcd":
            for n in encodings.position_feature_names(""):
                a, b = got[key][f"{c}{n}"], want[key][f"x{n}"] if key in want else None
                assert (a is None and b is None) or abs(a - b) < 1e-12


def test_rows_read_from_files_are_numbered_in_bounded_tasks(spark, monkeypatch, tmp_path):
    log = tables.search_log(spark, SF).select("srch_id", "prop_id", "position", "price_usd")
    log.write.parquet(str(tmp_path / "log"))
    want = sorted(tables.load_dataset(spark, str(tmp_path / "log")).collect())
    monkeypatch.setattr(tables, "TASK_ROWS", 200)
    dealt = tables.load_dataset(spark, str(tmp_path / "log"))
    assert dealt.rdd.getNumPartitions() == -(-len(want) // 200) and sorted(dealt.collect()) == want


def _keys(spark):
    log = row_features.add_cross_keys(tables.search_log(spark, SF).transform(add_relevance))
    names = ("row_id", "srch_id", "prop_id", "srch_destination_id", "site_id", "random_bool", "position", "price_usd", "relevance", "dcg_gain",
             "booking_bool", "click_bool", "_key_prop_dest", "_key_dest_site")
    return cut_lineage(log.select(*names)), (("prop_id", "prop"), ("site_id", "site"), ("_key_prop_dest", "prop_dest"), ("_key_dest_site", "dest_site"))


def test_passes_and_slices_give_the_same_rows_and_shuffle_a_part_at_once(spark, monkeypatch):
    log, specs = _keys(spark)
    own = cut_lineage(folds.group_folds(log, 3, 1))
    fit, apply = log.where("srch_id % 5 <> 0"), log.where("srch_id % 5 = 0")
    steps = {"frequency": lambda: fitted.add_frequency_features(fit, [apply], specs)[0],
             "segments": lambda: fitted.add_segment_profiles(fit, [apply], [(a, k) for k, a in specs], ["price_usd"])[0],
             "target": lambda: encodings.add_oof_target_encodings(fit, own, 40.0, specs), "position": lambda: encodings.add_oof_position_aggregates(fit, own, specs)}
    monkeypatch.setattr(keyed, "LOCAL_VALUES", 20)  # the sites alone
    kept, usual = [], keyed.materialize
    monkeypatch.setattr(keyed, "materialize", lambda df, label: kept.append(label) or usual(df, label))
    for name, step in steps.items():
        want = step()
        columns = sorted(c for c in want.columns if not c.startswith("_key"))
        want = sorted(want.transform(lambda d: d.select(*[r6(F.col(c)).alias(c) if t == "double" else c for c, t in d.select(*columns).dtypes])).collect(), key=str)
        assert "fitted" not in kept and "looked-up" not in kept
        with monkeypatch.context() as m:
            m.setattr(keyed, "PASS_CELLS", 12_000)
            got = step()
            got = sorted(got.select(*[r6(F.col(c)).alias(c) if t == "double" else c for c, t in got.select(*columns).dtypes]).collect(), key=str)
        assert len(got) == len(want) > 500 and got == want, name
        assert kept.count("fitted") >= 3 and kept.count("looked-up") >= 2, name
        kept.clear()


def test_item_profiles_fitted_in_passes_are_the_same(spark, monkeypatch, capsys):
    log, _ = _keys(spark)
    fit, apply = log.where("srch_id % 5 <> 0"), log.where("srch_id % 5 = 0")

    def made():
        out = fitted.add_prop_numeric_profiles(fit, apply)[1]
        out.explain("extended")
        return sorted(out.select("row_id", "prop_profile_price_usd_mean", "prop_profile_price_usd_median", "prop_profile_log_count").collect())

    want = made()
    dealt = [x for x in capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].splitlines() if "RepartitionByExpression" in x]
    assert len(dealt) == 1 and "prop_id" in dealt[0]
    monkeypatch.setattr(keyed, "PASS_CELLS", 3000)
    assert made() == want


def test_what_is_stored_for_a_step_alone_is_deleted(spark):
    log, _ = _keys(spark)
    base = spark.sparkContext._jvm.java.io.File(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.list())
    fitted.bucket_edges(log, [("price_usd", "b", 4)]).collect()
    assert set(base.list()) == before


def test_rows_numbered_in_slices_are_the_same(spark, monkeypatch, tmp_path):
    tables.search_log(spark, SF).drop("row_id").write.parquet(str(tmp_path / "log"))
    want = sorted(tables.load_dataset(spark, str(tmp_path / "log")).collect(), key=str)
    kept, usual = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, label: kept.append(label) or usual(df, label))
    monkeypatch.setattr(tables, "SLICE_ROWS", len(want) // 3)
    monkeypatch.setattr(tables, "TASK_ROWS", 500)
    assert sorted(tables.load_dataset(spark, str(tmp_path / "log")).collect(), key=str) == want and len(kept) >= 3


def test_the_csv_is_compressed_and_goes_when_it_is_parquet(spark, monkeypatch):
    seen = []
    usual = queries_misc.convert_csv_to_parquet

    def convert(spark, raw, out):
        seen.append(raw := raw.removeprefix("file:"))
        assert any(f.name.endswith(".csv.gz") for f in pathlib.Path(raw).iterdir())
        return usual(spark, raw, out)

    monkeypatch.setattr(queries_misc, "convert_csv_to_parquet", convert)
    assert QUERIES["s2_s3_csv_to_parquet"](spark, SF).count() == tables.search_log(spark, SF).count()
    assert len(seen) == 1 and not pathlib.Path(seen[0]).exists()


def test_segments_of_equal_values_have_no_deviation(spark):
    rows = spark.range(4200).selectExpr("id AS row_id", "pmod(id, 300) AS srch_destination_id", "sqrt(pmod(id, 300) + 2) / 3 AS prop_location_score1").repartition(7)
    out = fitted.add_segment_profiles(rows, [rows], [("dest", "srch_destination_id")], ["prop_location_score1"])[0]
    assert out.where("abs(dest_prop_location_score1_segment_zscore) > 1e-9").count() == 0
