import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankspark.llm import periodruns as R
from rankspark.llm import queries


def brute(words, least=6, times=4):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j
    return sorted((s, m, q) for (s, m), q in found.items())


def made(rng):
    words = []
    for _ in range(rng.randint(0, 5)):
        unit = rng.choices("abcdefg"[:rng.randint(1, 7)], k=rng.randint(1, 9))
        words += unit * rng.randint(1, 9) + unit[:rng.randint(0, len(unit))] + rng.choices("abcxyz", k=rng.randint(0, 6))
    return words


@pytest.mark.parametrize("least,times", [(6, 4), (1, 3), (20, 5)])
def test_runs_against_brute_force(least, times):
    rng = random.Random(5)
    texts = [made(rng) for _ in range(400)] + [list("ab") * 300, ["z"] * 1000, [str(i) for i in range(200)] * 5, ["x"] * 900 + ["y"] + ["x"] * 900,
                                               rng.choices("ab", k=2000), (["p"] * 30 + ["q"]) * 12]
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 800:
        fib = fib[1], fib[1] + fib[0]
    texts.append(fib[1])
    got = list(R.runs_of([" ".join(t).encode() for t in texts], least, times))
    for words, (n, runs, kept) in zip(texts, got, strict=True):
        want = brute(words, least, times)
        assert (n, [tuple(r) for r in runs.tolist()]) == (len(words), want)
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert kept.decode().split() == [w for i, w in enumerate(words) if i not in gone]


def test_matches_of_every_number_of_primes(monkeypatch):
    rng = np.random.default_rng(2)
    for b in (1, 2, 8, 64):
        block = rng.integers(1, min(b, 3) + 1, (7, b))
        window = rng.integers(0, min(b, 3) + 1, (7, 2 * b))
        window[::2, b // 2:b // 2 + b] = block[::2]
        want = np.array([[(w[o:o + b] == x).all() for o in range(b)] for x, w in zip(block, window)])
        assert (R.matches(block, window) == want).all()
    monkeypatch.setattr(R, "PRIMES", ((257, 3), (193, 5), (97, 5), (7681, 17)))  # small ones: several are needed
    block, window = rng.integers(1, 17, (9, 16)), rng.integers(0, 17, (9, 32))
    window[:, 5:21] = block
    assert (R.matches(block, window) == [[(w[o:o + 16] == x).all() for o in range(16)] for x, w in zip(block, window)]).all()


def test_long_runs_and_long_texts():
    words = [f"w{i}" for i in range(9000)]
    big = words[:7000] * 4 + words[:11] + ["end"] + ["again"] * 300_000 + words
    (n, runs, kept), = R.runs_of([" ".join(big).encode()])
    assert [tuple(r) for r in runs.tolist()] == [(0, 28011, 7000), (28012, 300_000, 1)]
    assert kept.decode().split() == [*words[:7000], "end", "again", *words]


def test_columns_nulls_and_query(spark, docs_of, tmp_path):
    rows = [(1, None), (2, ""), (3, " a b a b a b a b "), (4, "x"), (None, "q q q q q q"), (3, " a b a b a b a b "), (10, "un deux trois é " * 40)]
    df = docs_of(rows).selectExpr("*", "'old' as runs", "5 as n_words")
    got = [(r.doc_id, r.lang, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.periodic_runs(df).collect()]
    runs = {1: [], 2: [], 3: [(0, 8, 2)], 4: [], None: [(0, 6, 1)], 10: [(0, 160, 4)]}
    kept = {1: "", 2: "", 3: "a b", 4: "x", None: "q", 10: "un deux trois é"}
    assert sorted(got, key=str) == sorted([(i, "en", len((t or "").split()), runs[i], kept[i]) for i, t in rows], key=str)
    assert R.periodic_runs(docs_of([])).count() == 0
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text") \
        .unionByName(docs_of(rows[:-1]).select("doc_id", "text")).withColumn("runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    import hashlib
    import zlib
    want = []
    for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = brute(words)
        s, m, q = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        gone = {i for a, b, c in found for i in range(a + c, a + b)}
        want.append((r.doc_id, len(found), s, m, q, m and 1000 * m // q, hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()))
    assert sorted(map(tuple, queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 5
