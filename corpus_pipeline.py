"""The corpus pipeline: five stages, each of which calls one operator of ``rankspark.llm``.

A stage takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``docs``, whatever others than doc_id, text, source and n_chars
there are; those keep their values and never clash with an operator's own.

1. toxicity: texts scored 0.7 or more go.
2. near_duplicates: of each group of SimHash near-duplicates the row with the
   smallest doc_id stays, once.  Rows without an id stay.
3. repeated_text: each byte covered by a 50-byte string that also starts in a
   document of smaller doc_id leaves the text (with what is left of a
   character that it cuts); n_chars follows.  All rows stay.
4. decontamination: texts that hold a benchmark item go.
5. mixture: how many words the mix takes of each text.

Null and empty texts pass every stage as the empty text does there; an empty
table passes as one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.llm import decontam, mixing, simhash, suffixdedup, toxicity
from rankspark.llm.common import as_bytes, stored, table


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row as one column beside what operators read."""
    return docs.select("doc_id", "text", F.struct("*").alias("_row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(_packed(docs), model).where("predicted = 0").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(docs, size=4, radius=4, mark=True)
    first = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.min("mark").alias("mark"), F.count("*").alias("n")) \
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("n").alias("_n"))
    own = _packed(docs).withColumn("_text", F.xxhash64(as_bytes("text")))
    met = own.join(first, (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_mark")), "left") \
        .where(F.col("doc_id").isNull() | F.col("_id").isNotNull())
    # rows that repeat their id: one of them
    often = met.where("_n > 1").dropDuplicates(["_id"])
    return met.where("_n is null or _n = 1").unionByName(often).select("_row.*")


def drop_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    @F.pandas_udf("string")
    def as_text(kept: pd.Series) -> pd.Series:
        return pd.Series([k.decode("utf-8", "ignore") for k in kept], dtype=object)

    cut = suffixdedup.cut_duplicates(_packed(docs), length=50)
    text = F.when(F.col("n_spans") > 0, as_text("kept")).otherwise(F.col("_row.text"))
    changed = {"text": text} | ({"n_chars": F.when(F.col("n_spans") > 0, F.length(text)).otherwise(F.col("_row.n_chars"))} if "n_chars" in docs.columns else {})
    return cut.select(*[changed[c].alias(c) if c in changed else F.col("_row")[c].alias(c) for c in docs.columns])


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.with_leaks(_packed(docs), table(spark, sf_dir, "benchmark"), whole=True)
    return found.where(F.size("leaks") == 0).select("_row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_text", drop_repeated_text),
          ("decontamination", drop_benchmark_texts), ("mixture", mixture)]

#: Lexicon learning and fingerprints aren't SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
