import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankspark.llm import decontam as D

ITEM = "item_id long, text string"


def brute(docs, items, threshold=0.5, overlap=0.8, stride=64):
    """BM25 of every passage and item, and the overlap of those above the threshold."""
    items = [(i, D.words(t)) for i, t in sorted(set(items), key=str) if i is not None and D.words(t)]
    df = Counter(t for _, w in items for t in set(w))
    mean, n = sum(len(w) for _, w in items) / max(1, len(items)), len(items)
    stride = max([stride, *(len(w) for _, w in items)])
    out = []
    for d, text in docs:
        w = D.words(text)
        for i, iw in items:
            tf = Counter(iw)
            imp = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(iw) / mean)) for t, c in tf.items()}
            own = sum(imp.values())
            best, top = (0, 0), 0
            for at in range(0, len(w), stride):
                score = sum(imp[t] for t in set(w[at:at + 2 * stride]) if t in imp) / own
                if score >= threshold - 1e-9:
                    top = max(top, score)
                    near = w[max(0, at - stride):at + 3 * stride]
                    cut = len(iw) - math.ceil(len(iw) / 3)
                    got = []
                    for part in (iw[:cut], iw[cut:]):
                        g = D.shingles(part)
                        k = min(5, len(part))
                        here = {b" ".join(near[x:x + k]) for x in range(len(near) - k + 1)} if k else set()
                        got.append(len(g & here) / len(g) if g else 1.0)
                    best = max(best, tuple(got), key=min)
            if top and min(best) >= overlap:
                out.append((d, i, round(top, 6), round(best[0], 6), round(best[1], 6)))
    return sorted(out, key=str)


def listed(df):
    return sorted(((r.doc_id, r.item_id, round(r.score, 6), round(r.question_overlap, 6), round(r.answer_overlap, 6)) for r in df.collect()), key=str)


def test_sample_tables_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet").where("doc_id < 250"), spark.read.parquet(f"{d}/benchmark.parquet")
    got = listed(D.leak_pairs(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    whole = [r.doc_id for r in docs.collect() if any(i.text in r.text for i in items.collect())]
    assert whole and set(whole) <= {g[0] for g in got}


@pytest.mark.parametrize("settings", [{}, {"shard_chars": 300}])
def test_made_up_cases(spark, docs_of, settings):
    rng = random.Random(5)
    vocab = [f"w{int(rng.expovariate(0.03))}" for _ in range(3000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 90)))) for i in range(30)]
    items += [(99, None), (98, " . "), (None, "a b"), items[0], (97, items[1][1])]
    rows = []
    for d in range(60):
        w = rng.choices(vocab, k=rng.randint(0, 700))
        if d % 2:
            own = rng.choice(items[:30])[1].split()
            own = own[:max(1, int(len(own) * rng.choice([1, 1, 0.9, 0.6])))]
            at = rng.randint(0, len(w))
            w[at:at] = own
        rows.append((d, " ".join(w)))
    rows += [(100, None), (101, ""), (None, items[2][1]), (7, items[3][1].upper().replace(" ", ", ")), (7, items[3][1])]
    bench = spark.createDataFrame(items, ITEM)
    df = docs_of(rows).withColumn("leaks", F.lit(1)).withColumn("item_id", F.lit("x"))
    assert listed(D.leak_pairs(df, bench, **settings)) == brute(rows, items)


def test_empty_tables_and_an_answer_column(spark, docs_of):
    docs = docs_of([(1, "so what is six times seven then forty two of course"), (2, "what is six times seven")])
    assert D.leak_pairs(docs, spark.createDataFrame([], ITEM)).count() == 0
    assert D.leak_pairs(docs_of([]), spark.createDataFrame([(1, "a")], ITEM)).count() == 0
    bench = spark.createDataFrame([(5, "what is six times seven", "forty two")], "item_id long, text string, key string")
    assert [(r.doc_id, r.item_id) for r in D.leak_pairs(docs, bench, answer_col="key").collect()] == [(1, 5)]


def test_near_copies_with_a_word_changed_in_the_last_third(spark, docs_of, tmp_path):
    item = [f"w{i}" for i in range(37)]
    near, far, moved = list(item), list(item), item[25:] + item[:25]
    near[30] = "x"  # of the whole 28 of 33 shingles stay, of the last third 4 of 9
    far[8] = far[20] = far[30] = "x"
    rows = [(1, f"a b {' '.join(near)} c"), (2, f"a b {' '.join(far)} c"), (3, " ".join(item)), (4, " ".join(moved))]
    bench = spark.createDataFrame([(5, " ".join(item))], ITEM)
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    from rankspark.llm.queries import op2_decontaminate
    got = {r.doc_id: (r.question_overlap, r.answer_overlap) for r in op2_decontaminate(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 3, 4} and got[1] == (1, pytest.approx(4 / 9))
    import corpus_pipeline
    left = corpus_pipeline.drop_benchmark_texts(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert [r.doc_id for r in left.collect()] == [2]
    # a real answer column keeps the strict test of both
    keyed = spark.createDataFrame([(5, " ".join(item[:25]), " ".join(item[25:]))], "item_id long, text string, key string")
    assert {r.doc_id for r in D.leak_pairs(docs_of(rows), keyed, answer_col="key", whole=True).collect()} == {3, 4}
