import hashlib
import random

import numpy as np
import pytest

from rankspark.llm import spandedup as S


def brute(rows, length=50):
    rows = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, d in rows:
        if i is not None:
            for a in range(len(d) - length + 1):
                w = tuple(d[a:a + length])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, d in rows:
        gone = np.zeros(len(d), bool)
        if i is not None:
            for a in range(len(d) - length + 1):
                if first[tuple(d[a:a + length])] < i:
                    gone[a:a + length] = True
        kept = b" ".join(w for w, g in zip(d, gone) if not g)
        out.append((i, len(d), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_automaton_against_search():
    rng = random.Random(1)
    for _ in range(300):
        rows = [(rng.choices("ab" if rng.random() < 0.5 else "abcd", k=rng.randint(0, 14)), rng.randint(0, 9)) for _ in range(rng.randint(1, 6))]
        shard = S.Automaton()
        for symbols, low in rows:
            shard.add(symbols, low)
        shard.close()
        length = rng.randint(1, 5)
        for text in [rng.choices("abcd", k=20), *(r[0] for r in rows)]:
            want = [min((low for own, low in rows for a in range(len(own) - length + 1) if own[a:a + length] == text[i:i + length]), default=None)
                    for i in range(len(text) - length + 1)]
            assert shard.lows(text, length) == want


def test_sample_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert listed(S.span_report(df)) == brute([(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("bounds", [{}, {"shard_words": 100, "filter_bits": 16}])
def test_made_up_copies_and_shared_passages(docs_of, bounds):
    rng = random.Random(7)
    text = lambda n, v=900: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    shared = [text(rng.randint(40, 130)) for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), 90):
        parts = [rng.choice(shared) if rng.random() < 0.5 else text(rng.randint(1, 40)) for _ in range(rng.randint(0, 5))]
        rows.append((i, "\n".join(parts)))
    rows += [(2000 + i, rows[i % 5][1] + " more" * (i % 3)) for i in range(20)]
    rows += [(3000, "z " * 200), (3001, "z " * 120), (3002, "a b " * 80), (3003, "b a " * 80), (3004, text(3000, 2)), (3005, text(3000, 2))]
    line = text(60)
    rows += [(4000 + i, f"{text(30)} {line} {text(30)}") for i in range(60)]
    assert listed(S.span_report(docs_of(rows), **bounds)) == brute(rows)


def test_null_empty_repeated_ids_and_clashing_columns(docs_of):
    t = " ".join(f"word{i} again" for i in range(60))
    rows = [(1, None), (2, ""), (3, t), (4, t), (4, t), (None, t), (5, "short"), (5, "x " + t), (6, " \t" + t.upper() + "\x0b"), (7, "é " + t)]
    df = docs_of(rows).selectExpr("*", "1 as kept", "2 as spans", "3 as mark", "4 as n_words")
    assert listed(S.span_report(df)) == brute(rows)
    got = {(r.doc_id, r.text): r for r in S.cut_spans(df).collect()}
    assert got[(4, t)].kept == "" and [tuple(x) for x in got[(4, t)].spans] == [(0, 120)] and got[(3, t)].kept == t
    assert S.span_report(docs_of([])).count() == 0


def test_very_long_text(docs_of):
    rng = random.Random(3)
    long = rng.choices([f"v{i}" for i in range(5000)], k=1_200_000)
    rows = [(1, " ".join(long)), (2, " ".join(["start", *long[1_040_000:1_050_000], "end"])), (3, " ".join(long[-60:]))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.span_report(docs_of(rows)).collect()}
    assert got == {1: (1_200_000, 0), 2: (10_002, 10_000), 3: (60, 60)}
