import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from rankspark.llm import simhash as S


def brute_fp(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps, radius):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def check(df, rows):
    got = {r.doc_id: r for r in df.collect()}
    fps = {i: brute_fp(t) for i, t in rows}
    want = brute_components(fps, 4)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == want


def test_sample_table_against_brute_force(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"]))
    check(S.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), rows)


def test_null_empty_ties_repeated_long_and_extra_columns(spark, docs_of):
    rows = [(5, "a b c d e"), (3, "A B C D E"), (9, None), (7, ""), (8, " \t\n"), (4, "b"), (2, "B"), (6, "one two " * 40000), (1, "é É")]
    df = docs_of(rows).selectExpr("*", "0 as fp", "1 as key").withColumnRenamed("n_chars", "root")
    check(S.near_duplicates(df), rows)
    twice = S.near_duplicates(df.union(df))
    assert twice.count() == 2 * len(rows)
    assert S.near_duplicates(docs_of([(None, "a b"), (None, "a b"), (1, "zz yy")])).where("doc_id is null and component_id is null").count() == 2


def test_empty_table(docs_of):
    assert S.near_duplicates(docs_of([])).count() == 0


@pytest.mark.parametrize("shard_rows", [3, 2048])
def test_links_of_a_hot_cluster_in_small_shards(spark, shard_rows):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(120)}
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = {r.node: r.root for r in S.components(S.links(frame, 4, 2, shard_rows)).collect()}
    want = brute_components({f: f for f in fps}, 4)
    classes = {}
    for f in fps:
        s = int(np.uint64(f).astype(np.int64))
        classes.setdefault(got.get(s, s), set()).add(f)
    other = {}
    for f, r in want.items():
        other.setdefault(r, set()).add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, other.values()))
