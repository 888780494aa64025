import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankspark.llm import collocations as C


def brute(rows, least, longest=5, share=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {k for k, v in f.items() if v >= least and len(k) > 2}
    inside = {(k[0], *k[i:i + m]) for k in cand for m in range(2, len(k) - 1) for i in range(1, len(k) - m + 1)
              if 100 * f[k] >= share * f[(k[0], *k[i:i + m])]}
    out = []
    for lang in n:
        own = []
        for k in cand - inside:
            if k[0] == lang:
                score, at = min((1000 * f[k] * n[lang] // (f[k[:i + 1]] * f[(lang, *k[i + 1:])]), i) for i in range(1, len(k) - 1))
                own.append((-score, -f[k], " ".join(k[1:]).encode(), f[k[:at + 1]], f[(lang, *k[at + 1:])]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1)]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(t, g, i, "x") for i, (t, g) in enumerate(rows)], "text string, lang string, ids long, phrase string")


def listed(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_permutation_is_undone():
    rng = np.random.default_rng(1)
    for n in range(1, 6):
        ids = rng.integers(0, 1 << 64, (1000, n), np.uint64)
        ids[:4] = [[0], [1], [(1 << 64) - 1], [1 << 63]]
        assert (C.restored(*C.permuted(ids)) == ids).all()
    assert len(np.unique(C.permuted(np.arange(4096, dtype=np.uint64)[:, None])[0] >> np.uint64(56))) == 256


@pytest.mark.parametrize("n", [1, 2, 5])
def test_filters_count_and_merge(n):
    rng = np.random.default_rng(n)
    parts, total = [], Counter()
    for size in (0, 1, 50, 9000, 400):
        ids = rng.integers(0, 6 if size < 9000 else 4000, (size, n), np.uint64)
        head, tail = C.permuted(ids)
        if size == 400:
            head = head & np.uint64(3) << np.uint64(62)  # many keys of one head
        total.update(map(tuple, np.column_stack((head, tail)).tolist()))
        parts.append(C.QuotientFilter(head, tail, np.ones(size, np.int64)))
    parts.append(C.QuotientFilter(head[:1], tail[:1], np.array([10 ** 12])))
    total[tuple(np.column_stack((head, tail))[0].tolist())] += 10 ** 12
    pages = [C.QuotientFilter.merged([C.QuotientFilter.from_bytes(p.to_bytes()) for p in parts])]
    assert len(pages[0].large) and len(pages[0].to_bytes()) < 8 * (n + 1) * len(pages[0]) + 300_000
    cut = [(page, C.QuotientFilter.from_bytes(data)) for page, data in pages[0].pages(7)]
    assert [p for p, _ in cut] == sorted({p for p, _ in cut})
    for filters in (pages, [f for _, f in cut]):
        got = Counter()
        for f in filters:
            assert (np.diff(f.heads().astype(object)) >= 0).all()
            got.update(dict(zip(map(tuple, np.column_stack((f.heads(), f.tail)).tolist()), f.counts().tolist())))
        assert got == total


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "of", "New", "york", "city", "éa", "ÉA", "a'b", "x-y", " ", "z\x00"]
    rows = [(None, "en"), ("", None), (" ,.;", "en"), ("New York City of the new york city " * 40, "fr")]
    for _ in range(200):
        text = "".join(rng.choice(words[:6] if rng.random() < 0.7 else words) + rng.choice([" "] * 9 + ["\t", "  ", ", ", "\n", ". ", "\x0b", "! "])
                       for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "de", "und", None])))
    rows += rows[50:60]
    df = table_of(spark, rows)
    for least, longest, share, top in ((5, 5, 100, 2000), (3, 4, 60, 7), (40, 2, 100, 2000)):
        want = brute(rows, least, longest, share, top)
        assert listed(C.collocations(df, least=least, longest=longest, share=share, top=top, filter_bits=16)) == want and want


def test_small_buffers_and_full_filters(spark):
    # the sizes are read where the tasks run, so they are set there
    def small(run):
        def wrapped(*args):
            C.BUFFER, C.FULL = 64, 128
            return run(*args)
        return wrapped

    rng = random.Random(4)
    rows = [(" ".join(rng.choices("abcdefgh", k=200)), "en") for _ in range(60)]
    df = table_of(spark, rows).repartition(3)
    frame = type(df)
    plain = frame.mapInPandas
    try:
        frame.mapInPandas = lambda self, f, schema: plain(self, small(f), schema)
        got = listed(C.collocations(df, least=4))
    finally:
        frame.mapInPandas = plain
    assert got == brute(rows, 4)


def test_words_of_one_id_are_counted_with_another_seed(spark):
    class Alike(C.Words):
        def __init__(self, texts, space, names=None):
            super().__init__(texts, space, names)
            if names is None:
                self.hashes[:] = 7

    def patched(run):
        def wrapped(*args):
            C.Words = Alike
            return run(*args)
        return wrapped

    rows = [("a b c. a b d", "en"), ("a b", "fr")] * 4
    frame = type(spark.range(1))
    plain = frame.mapInPandas
    try:
        frame.mapInPandas = lambda self, f, schema: plain(self, patched(f), schema)
        got = listed(C.collocations(table_of(spark, rows), least=4))
    finally:
        frame.mapInPandas = plain
    assert got == brute(rows, 4) and got


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.text, r.lang) for r in df.collect()], 30)
    assert listed(C.collocations(df, least=30)) == want and want


def test_exact_products(spark):
    big = [(10 ** 13 + 7, 10 ** 15 - 1, 10 ** 14 + 3, 10 ** 13 + 9), (100, 10 ** 16, 100, 100), (3, 7, 2, 11)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = [r.s for r in df.select(C.thousandths("a", "n", "l", "r").alias("s")).collect()]
    assert got == [1000 * a * n // (x * r) for a, n, x, r in big]


def test_empty_table(spark):
    assert C.collocations(table_of(spark, [("a", "b")]).limit(0)).count() == 0
    assert C.collocations(table_of(spark, [(None, None)])).withColumn("x", F.lit(1)).count() == 0
