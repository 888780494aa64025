import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rankspark.llm import topk
from rankspark.llm.topk import top_k


def brute(rows, k=5, every=50):
    good = {}
    for i, v in sorted({(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
                   if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}):
        good.setdefault(i, v)
    good = sorted(good.items())
    out = []
    for qi, q in good:
        if qi % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("nodes,shard_rows,pack", [(2, 2048, 256), (4, 40, 7)])
def test_sample_against_brute_force(spark, nodes, shard_rows, pack):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    t = pq.read_table(path).to_pydict()
    got = top_k(spark.read.parquet(path), nodes=nodes, shard_rows=shard_rows, pack=pack, every=20)
    assert sorted(map(tuple, got.collect())) == brute(list(zip(t["vec_id"], t["embedding"])), every=20)


def test_nulls_ties_repeats_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (50, [1.0, -0.5]), (1, [1.0, -0.5]), (2, [0.1, None]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, [0.3]), (7, []), (None, [1.0, 1.0]), (1, [1.0, -0.5]), (8, [-1.0, 9.0]), (8, [2.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    assert sorted(map(tuple, top_k(df).collect())) == brute(rows)


def test_a_vector_that_very_many_rows_share(spark):
    rows = [(i, [0.5, 0.25, -0.1] if i % 3 else [0.1 * (i % 7), 0.2, 0.3]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, top_k(df, every=40, shard_rows=64).collect())) == brute(rows, every=40)


def test_empty(spark):
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pairs_of_shards_and_queries_are_not_broadcast(spark, monkeypatch):
    plans, usual = {}, topk.stored

    def kept(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return usual(df, label)

    monkeypatch.setattr(topk, "stored", kept)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    top_k(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), shard_rows=10, pack=4, every=5)
    for label in ("first", "second"):
        assert "Broadcast" not in plans[label] and "Exchange" not in plans[label] and "CartesianProduct" in plans[label]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
