import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline as P
import test_decontam
import test_mixing
import test_simhash
import test_suffixdedup
from pyspark.sql import functions as F

from rankspark.llm import toxicity
from rankspark.llm.common import stored

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "'keep' as score", "doc_id + 0.5 as mark", "1 as _id2")
    model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    out = {}
    now = docs
    for name, stage in P.STAGES[:-1]:
        now = out[name] = stored(stage(spark, now, SF), name)
        assert now.columns == docs.columns
        assert now.where("score <> 'keep' or mark <> doc_id + 0.5").count() == 0
    start = rows(docs)
    scored = {i: model.scores(__import__("numpy").array([model.measures(t)]))[0] for i, t in start}
    clean = [(i, t) for i, t in start if scored[i] < 0.7]
    assert rows(out["toxicity"]) == clean
    part = test_simhash.brute_components({i: test_simhash.brute_fp(t) for i, t in clean}, 4)
    single = [(i, t) for i, t in clean if part[i] == i]
    assert rows(out["near_duplicates"]) == single
    want = {b[0]: b for b in test_suffixdedup.brute(single)}
    cut = rows(out["repeated_text"])
    assert [i for i, _ in cut] == [i for i, _ in single]
    for (i, new), (_, old) in zip(cut, single):
        assert (new == old) == (want[i][2] == 0)
        assert 0 <= len(old.encode()) - want[i][2] - len(new.encode()) <= 6 * max(1, want[i][3])
    assert out["repeated_text"].where("n_chars <> length(text)").count() == 0 or docs.where("n_chars <> length(text)").count()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {b[0] for b in test_decontam.brute(cut, items)}
    assert rows(out["decontamination"]) == [(i, t) for i, t in cut if i not in leaked]
    test_mixing.check(P.mixture(spark, now, SF), [(r.doc_id, r.text, r.source) for r in now.collect()])


@pytest.mark.parametrize("empty", [False, True])
def test_null_empty_repeated_rows(spark, docs_of, tmp_path, empty):
    t = "one two three four five six seven eight nine ten"
    made = [] if empty else [(1, t), (1, t), (2, t.upper()), (3, None), (4, ""), (None, t), (None, None), (5, "x " * 60000), (6, "é" * 60 + "a"), (7, "ab" + "é" * 60)]
    d = str(tmp_path)
    docs_of(made).withColumn("leaks", F.lit(1)).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    got = sorted((r.doc_id or 0, r.size) for r in P.run(spark, d).collect())
    assert got == ([] if empty else [(0, 0), (0, 10), (1, 10), (3, 0), (5, 60000), (6, 1), (7, 1)])
