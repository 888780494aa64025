import random
from collections import defaultdict

import pytest

from rankspark.llm import mixing as M


def sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@pytest.mark.parametrize("votes,seats", [([53, 24, 23], 7), ([5, 5, 5, 5], 6), ([1000, 1, 1], 3), ([7], 9), ([1.5, 0, 2.5], 100), ([3, 1, 4, 1, 5, 9, 2, 6] * 20, 77)])
def test_apportionment_against_highest_quotients(spark, votes, seats):
    df = spark.createDataFrame([(i, float(v), seats) for i, v in enumerate(votes)], "p long, v double, seats long")
    got = [r.quota for r in M.apportion(df, "v", "seats", ["p"], []).orderBy("p").collect()]
    assert got == sainte_lague(votes, seats)


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing; ``sizes`` in source order."""
    w = [weights[i % 3] for i in range(len(sizes))]
    total, out = sum(sizes), [None] * len(sizes)
    while True:
        rest = total - sum(o for o in out if o is not None)
        free = [i for i, o in enumerate(out) if o is None]
        ws = sum(w[i] for i in free)
        over = [i for i in free if rest * w[i] / ws >= most * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * w[i] / ws
            return out
        for i in over:
            out[i] = most * sizes[i]


def check(df, rows):
    got = [r.asDict() for r in df.collect()]
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").encode().split())
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    want = dict(zip(names, water([size[s] for s in names]))) if sum(size.values()) else dict.fromkeys(names, 0)
    assert len(got) == len(rows)
    of = {(i, t): s for i, t, s in rows}
    taken = defaultdict(int)
    by_id = {i: (t, s) for i, t, s in rows}
    for g in got:
        t, s = by_id[g["doc_id"]]
        assert g["size"] == len((t or "").encode().split()) and g["source_size"] == size[s]
        assert g["target"] == pytest.approx(want[s])
        assert 0 <= g["taken"] <= 3 * g["size"]
        taken[s] += g["taken"]
    return size, want, taken


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    out = M.mix(df)
    size, want, taken = check(out, rows)
    for s in size:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 130)
    assert sorted(map(tuple, M.mix(df).collect())) == sorted(map(tuple, out.collect()))


def test_many_shards_and_small_blocks(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 60))), "ab"[i % 7 == 0]) for i in range(400)]
    size, want, taken = check(M.mix(docs_of(rows), block=8, shard_words=500), rows)
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 8 * (1 + size[s] / 500)


def test_null_empty_repeated_ties_and_empty_table(docs_of):
    rows = [(1, None, "é"), (2, "", "z"), (3, "a b c\x0bd", None), (4, "x " * 90000, "z"), (5, "one two", "Z"), (6, "q", "")]
    check(M.mix(docs_of(rows).selectExpr("*", "1 as size", "2 as target")), rows)
    assert M.mix(docs_of([(None, "a b", None), (None, "a b", None), (7, "a b", "s"), (7, "a b", "s")])).count() == 4
    check(M.mix(docs_of([(1, None, "a"), (2, " ", None)])), [(1, None, "a"), (2, " ", None)])
    assert M.mix(docs_of([])).count() == 0
