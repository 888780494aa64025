import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankspark.llm import bpecount

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counts(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_sample_table_against_the_library(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = bpecount.token_counts(df, PATH).collect()
    assert [r.n_tokens for r in rows] == counts(library, [r.text for r in rows])
    assert all(r.n_bytes == len(r.text.encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_odd_texts(library):
    rng = random.Random(3)
    alpha = [chr(c) for c in [*range(0x250), 0x1680, 0x2000, 0x2028, 0x3000, 0x200B, 0x4E00, 0x1F600, 0x663, 0x2160, 0x300, 0xFEFF]]
    texts = ["".join(rng.choice(alpha if rng.random() < 0.5 else "ab 'st\n  aaa") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * k for k in range(100)] + ["<|endoftext|>" * 3 + " x<|endoftext|> <|endoftext|", "", " ", "a b\n", " a b", "a  b ", "x 's \ty"]
    m = bpecount.merger(PATH)
    assert [n for g in bpecount.groups(texts) for n in m.count(g)] == counts(library, texts)


def test_a_full_table_of_counts_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpecount, "KEPT", 5)
    monkeypatch.setattr(bpecount, "GROUP", 3)
    texts = [f"word{i % 7} and thing{i} {'z' * (i % 60)}" for i in range(40)]
    m = bpecount.Merger(PATH)
    assert [n for g in bpecount.groups(texts) for n in m.count(g)] == counts(library, texts)


def test_null_empty_long_repeated_and_extra_columns(spark, docs_of, library):
    texts = [None, "", "x" * 300000, "one two " * 50000, "a", "a"]
    df = docs_of([(None if i == 4 else 5, t) for i, t in enumerate(texts)]).withColumn("n_tokens", F.lit("clash"))
    got = bpecount.token_counts(df, PATH).collect()
    assert sorted(r.n_tokens for r in got) == sorted(counts(library, texts))
    assert bpecount.token_counts(docs_of([]), PATH).count() == 0
