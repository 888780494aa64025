import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankspark.llm import toxicity as T


def test_fold():
    assert T.fold("Th3 1D10T, ｉｄｉｏｔ іdіоt id​iot ïdiot $tupid price$$$") == " the idiot idiot idiot idiot idiot stupid price "
    assert T.fold(None) == T.fold("") == T.fold(" ...") == " "


def test_hits_exceptions_and_length():
    m = T.Model({" idiot ": 5.0, " lowe": 4.0, " lowei ": 6.0}, [" not an idiot "], (-3.0, 2.0, 1.0))
    assert sum(m.hits(T.fold("an idiot lowei lowest")).values()) == 15
    assert m.hits(T.fold("not an idiot")) == {}
    assert sum(m.hits(T.fold("not an idiot, idiot")).values()) == 5
    near, far = m.measures("idiot one two"), m.measures("idiot " + "word " * 500)
    assert near[0] == far[0] and near[1] > far[1]
    # brute force over words
    words = T.fold("ab idiot cd lowera lowe idiots").split()
    assert sum(m.hits(f" {' '.join(words)} ").values()) == sum(5.0 * (w == "idiot") + (6.0 if w == "lowei" else 4.0 * w.startswith("lowe")) for w in words)


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_on_the_sample_tables(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = T.scored(docs, T.learn(docs, labels)).select("doc_id", "held_out", "score", "predicted").join(labels, "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.held_out == out.doc_id.map(held)).all()
    wrong = (out.predicted != out.toxic).mean()
    assert wrong < 0.035, wrong
    assert np.isfinite(got.score).all() and got.score.between(0, 1).all()


def test_different_texts_that_share_a_long_word_all_count(spark, docs_of):
    shared = "extraordinary"
    assert len({T.signature(f"{shared} {w}") for w in ("one", "two", "three", "one two")}) == 4
    assert T.signature("Th3 idiot, twice") == T.signature("the 1d10t twice")
    rows = [(i, f"{shared} {'idiot' if i % 3 == 0 else 'fine'} {chr(97 + i % 26) * 3} {chr(97 + i // 26) * 3}") for i in range(90)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    model = T.learn(docs_of(rows), labels)
    assert any(" idiot ".startswith(t) for t in model.weights) and shared[:4] not in "".join(model.weights)


def test_null_empty_long_repeated_and_clashing_columns(spark, docs_of):
    rows = [(i, f"word {'idiot' if i % 3 == 0 else 'fine'} text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, 0, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows)
    model = T.learn(docs, labels)
    odd = docs_of([(None, "1d10t"), (1, None), (2, ""), (3, "fine " * 200000), (3, "idiot"), (3, "idiot")]).withColumn("score", F.lit("x"))
    got = T.scored(odd, model).collect()
    assert [r.predicted for r in got] == [1, 0, 0, 0, 1, 1]
    assert T.scored(docs_of([]), model).count() == 0
    none = T.learn(docs, labels.limit(0))
    assert {r.score for r in T.scored(docs, none).collect()} == {0.0}
