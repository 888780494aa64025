"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.llm.bpecount import token_counts
from rankspark.llm.collocations import collocations
from rankspark.llm.common import WORD, table
from rankspark.llm.decontam import leak_pairs
from rankspark.llm.lmscore import score
from rankspark.llm.mixing import mix
from rankspark.llm.periodruns import longest_run, periodic_runs
from rankspark.llm.simhash import near_duplicates
from rankspark.llm.spandedup import span_report
from rankspark.llm.suffixdedup import dedup_report
from rankspark.llm.toolcalls import CHAT_SCHEMAS, SCHEMA, conversation_calls, link
from rankspark.llm.topk import top_k
from rankspark.llm.toxicity import learn, scored
from rankspark.llm.warc import capture_index


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_index(table(spark, sf_dir, "pages"), least=0) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_bpe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")) \
        .select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"), length=50)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4, seed=42)


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    return link(calls, results, spark.createDataFrame(CHAT_SCHEMAS, SCHEMA)) \
        .select("conv_id", "call_id", "turn", "level", "linked", "valid", F.array_join("errors", ";").alias("errors"), "canonical")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, longest=5, share=100, top=2000)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where one text in ten goes on as a repetition from some word on (a null id counts as the empty text)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)).alias("w"))
    n = F.greatest(F.size("w").cast("long"), F.lit(1).cast("long"))
    marked = words.withColumn("g", F.expr("h div 10")).withColumn("a", F.col("g") % n).withColumn("n", n) \
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                        lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return marked.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.size("w") > 0), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")), least=6, times=4).withColumn("best", longest_run())
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(table(spark, sf_dir, "documents"), length=50)


QUERIES = {
    "op1_warc_index": op1_warc_index,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_score": op3_lm_score,
    "op4_bpe_counts": op4_bpe_counts,
    "op5_toxicity": op5_toxicity,
    "op6_mix": op6_mix,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash": op8_simhash,
    "op9_tool_calls": op9_tool_calls,
    "op10_topk": op10_topk,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_span_dedup": op13_span_dedup,
}

_OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

# base32 of the SHA-1: five hex digits are four base32 digits
_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM d"""

# Turns of a conversation without repeats: each call's level counts the calls that lead to it.
_OP9 = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'system') AND conv_id IS NOT NULL AND turn IS NOT NULL),
walk AS (
  SELECT conv_id, turn, 0 AS level FROM c a
  UNION
  SELECT c.conv_id, c.turn, walk.level + 1 FROM walk JOIN c ON c.conv_id = walk.conv_id AND c.turn IN (walk.turn + 1, walk.turn + 2)),
l AS (SELECT conv_id, turn, max(level) AS level FROM walk GROUP BY 1, 2),
r AS (SELECT conv_id, turn - 1 AS turn, turn AS own, text, true AS linked FROM conversations WHERE role = 'assistant'),
j AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS ref, coalesce(c.turn, r.own) AS turn, l.level, c.role, c.text,
    c.role IS NOT NULL AS called, coalesce(r.linked, false) AS found, r.text AS result
  FROM (c JOIN l USING (conv_id, turn)) FULL JOIN r ON c.conv_id = r.conv_id AND c.turn = r.turn),
e AS (SELECT *, CASE WHEN NOT called THEN 'result: no call' WHEN NOT found THEN 'result: missing' ELSE '' END AS errors FROM j)
SELECT conv_id, conv_id || ':' || ref AS call_id, turn, level, called AND found AS linked, errors <> 'result: no call' AS valid, errors,
  '{' || CASE WHEN called THEN '"arguments":' || CASE WHEN role = 'user' THEN '{"prompt":' || to_json(text) || ',"turn":' || turn || '}'
      ELSE '{"instructions":' || to_json(text) || '}' END || ',' ELSE '' END
    || '"call_id":"' || conv_id || ':' || ref || '","conv_id":' || conv_id
    || CASE WHEN called THEN ',"depends_on":[' || CASE WHEN CAST(conv_id || ':' || (turn - 2) AS VARCHAR) < conv_id || ':' || (turn - 1)
        THEN '"' || conv_id || ':' || (turn - 2) || '","' || conv_id || ':' || (turn - 1) || '"'
        ELSE '"' || conv_id || ':' || (turn - 1) || '","' || conv_id || ':' || (turn - 2) || '"' END || ']' ELSE '' END
    || ',"errors":[' || CASE WHEN errors = '' THEN '' ELSE '"' || errors || '"' END || ']'
    || CASE WHEN called THEN ',"level":' || level || ',"name":"' || CASE WHEN role = 'user' THEN 'reply' ELSE 'configure' END || '"' ELSE '' END
    || CASE WHEN found THEN ',"result":' || to_json(result) ELSE '' END || ',"turn":' || turn || '}' AS canonical
FROM e"""

_OP11 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
m AS (SELECT unnest(range(1, 6)) AS m),
i AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, m WHERE len(w) >= m),
f AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, m, count(*) AS f FROM i GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
k AS (SELECT c.*, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, l.f AS l, r.f AS r, n.n, k.k,
    CAST((CAST(1000 AS HUGEINT) * k.a * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN n ON n.lang = k.lang
  JOIN f l ON l.lang = k.lang AND l.m = k.k AND l.phrase = array_to_string(list_slice(k.ws, 1, k.k), ' ')
  JOIN f r ON r.lang = k.lang AND r.m = k.m - k.k AND r.phrase = array_to_string(list_slice(k.ws, k.k + 1, k.m), ' ')
  WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = k.lang AND x.m > k.m AND 100 * x.a >= 100 * k.a
    AND contains(' ' || x.phrase || ' ', ' ' || k.phrase || ' '))),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000"""

_OP13 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
k AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(list_slice(w, i, i + 49), ' ')) AS first FROM s),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM k WHERE first < doc_id),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
n AS (SELECT p.doc_id, count(r.j) AS n_removed, string_agg(CASE WHEN r.j IS NULL THEN p.word END, ' ' ORDER BY p.j) AS kept
  FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.j = r.j GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id"""

ORACLES: dict[str, str] = {"op1_warc_index": _OP1, "op9_tool_calls": _OP9, "op10_topk": _OP10, "op11_collocations": _OP11, "op13_span_dedup": _OP13}
