import base64
import hashlib
import random

from pyspark.sql import types as T

from rankspark.llm import warc as W

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("refers_to", T.StringType())])


def brute(rows, least):
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    top = {}
    for i, h in rows:
        k = h or ""
        top[k] = max(top.get(k, -1), -1 if i is None else i)
    out = []
    for i, h in rows:
        again = len((h or "").encode()) >= least and top[h or ""] != (-1 if i is None else i)
        out.append((i, len((h or "").encode()), sha(h), "revisit" if again else "response", top[h or ""] if again else None))
    return sorted(out, key=str)


def columns(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip_with_copies_nulls_ties_and_clashing_columns(spark):
    big = (1 << 60) + 1
    rows = [(1, "http://a.b/c", "x"), (big, None, "x"), (3, "http://www.a.b", None), (4, "bad url\n \x00", ""), (None, "u", "x"), (5, "http://[", "é\r\n\r\nWARC/1.1\r\n"),
            (6, "u", "y" * 400000), (7, "u", "solo"), (7, "u", "solo")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    assert columns(W.capture_index(df, 0, per_file=2)) == brute([(i, h) for i, _, h in rows], 0)
    assert columns(W.capture_index(df, 2)) == brute([(i, h) for i, _, h in rows], 2)
    assert W.capture_index(df.limit(0)).count() == 0


def test_sample_table_is_globally_ordered(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.html) for r in df.collect()]
    got = W.capture_index(df.union(df.selectExpr("page_id + 100000", "url", "html")), per_file=7)
    assert columns(got) == brute(rows + [(i + 100000, h) for i, h in rows], 0)
    listed = [(r.url_key, r.captured, r.page_id) for r in got.collect()]
    assert listed == sorted(listed)


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(((str(rng.randint(0, 9)), "t", rng.randint(0, 5), 0, "", "", None, f"a{i}", j) for j in range(rng.randint(0, 12))), key=W.order) for i in range(k)]
        assert list(W.LoserTree(runs)) == sorted((c for r in runs for c in r), key=W.order)
