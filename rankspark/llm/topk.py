"""Exact top-k inner products by the three-phase uniform threshold method.

Vectors are cut two ways: into shards of bounded rows and, within a shard,
into ``nodes`` blocks of components.  A node knows one addend of each score,
the inner product over its own components.

1. Every node sends, for each query, its ``k`` highest addends and its lowest
   one.  The whole scores of these few vectors are looked up; the k-th highest
   is a safe cutoff of the query.
2. Every node gets the cutoff's equal share (above the lowest addend) and
   sends all addends that reach it.  A score that reaches the cutoff has at
   least one such addend, so no result is missed.  Bounds with these entries
   give a higher cutoff; what can't reach it goes.
3. Scores of which an addend is still unknown are resolved from the vectors.

Of equal vectors only the ``k + 1`` smallest ids can be among a query's best;
the others are no candidates, so a vector that very many rows share costs no
more than one that few do.  All of them are queries where their id says so.

Queries are the stated set of rows whose id is divisible by ``every``; they
meet the shards in blocks of ``pack`` queries.  A task reads its shards and the
stored blocks itself, so that pairs of the two are neither shuffled nor sent
through the driver.

Vectors that are null or hold a null, NaN or infinite component take no part,
nor do rows without an id.  Shorter vectors count as padded with zeros.
Of several rows with one id the one with the least vector counts; a query's
own id is never its candidate.  Ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm.common import batches_of, stored

PACK = "shard int, block int, ids binary, mat binary, dims int"
#: Pairs of a shard's and a block's matrices in a worker's batch.
PAIRS = 32


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id``, ``vec`` (array of long) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite) \
        .select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("vec"))


def _matrix(vecs: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vecs), dims), np.int64)
    for i, v in enumerate(vecs):
        out[i, :len(v)] = v
    return out


def _packs(df: DataFrame, rows: int, nodes: int, dims: int, n: int) -> DataFrame:
    """Rows of up to ``rows`` vectors each, one for each block of components; shard numbers are set by :func:`_numbered`."""
    cuts = [dims * i // nodes for i in range(nodes + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def give(part):
            ids, mat = part["vec_id"].to_numpy(np.int64), _matrix(part["vec"], dims)
            return pd.DataFrame([(0, b, ids.tobytes(), np.ascontiguousarray(mat[:, cuts[b]:cuts[b + 1]]).tobytes(), cuts[b + 1] - cuts[b])
                                 for b in range(nodes)], columns=["shard", "block", "ids", "mat", "dims"])

        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            while len(held) > rows:
                yield give(held[:rows])
                held = held[rows:].reset_index(drop=True)
        if held is not None and len(held):
            yield give(held)

    packs = df.repartition(n, "vec_id").sortWithinPartitions("vec_id").mapInPandas(run, PACK).withColumn("at", F.floor(F.monotonically_increasing_id() / F.lit(nodes)))
    return packs


def _numbered(packs: DataFrame, label: str) -> DataFrame:
    """Packs stored, with consecutive shard numbers."""
    held = stored(packs, label)
    # one narrow row for each pack of thousands of vectors
    order = held.where("block = 0").select("at").rdd.map(lambda r: r[0]).sortBy(lambda x: x).zipWithIndex().toDF("at long, shard int")
    return stored(held.drop("shard").join(order, "at").select("shard", "block", "ids", "mat", "dims"), label)


def _product(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products: in double arithmetic where every sum is below 2**53."""
    if v.shape[1] and float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * v.shape[1] < 2.0 ** 52:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return q @ v.T


def _sides(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, qids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.qids, np.int64)
    v = np.frombuffer(row.mat, np.int64).reshape(len(ids), row.dims)
    q = np.frombuffer(row.qmat, np.int64).reshape(len(qids), row.dims)
    return ids, v, qids, q


def _first(k: int):
    """Phase 1 at a node: the lowest addend (vec_id null) and the k highest of every query."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                ids, v, qids, q = _sides(row)
                p = _product(v, q)
                own = ids[None, :] == qids[:, None]
                low = p.min(axis=1)
                yield pd.DataFrame({"query_id": qids, "block": row.block, "vec_id": pd.array([None] * len(qids), "Int64"), "part": low})
                ranked = np.where(own, np.iinfo(np.int64).min, p)
                top = np.argpartition(-ranked, min(k, len(ids)) - 1, axis=1)[:, :k] if len(ids) > k else np.tile(np.arange(len(ids)), (len(qids), 1))
                r = np.repeat(np.arange(len(qids)), top.shape[1])
                c = top.reshape(-1)
                ok = ~own[r, c]
                yield pd.DataFrame({"query_id": qids[r[ok]], "block": row.block, "vec_id": pd.array(ids[c[ok]], "Int64"), "part": p[r[ok], c[ok]]})
    return run


def _second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Phase 2 at a node: every addend that reaches the query's cutoff of this block."""
    for b in batches:
        for row in b.itertuples():
            ids, v, qids, q = _sides(row)
            p = _product(v, q)
            cut = np.frombuffer(row.cuts, np.int64)
            r, c = np.nonzero((p >= cut[:, None]) & (ids[None, :] != qids[:, None]))
            yield pd.DataFrame({"query_id": qids[r], "block": row.block, "vec_id": ids[c], "part": p[r, c]})


def _kth(bounds: DataFrame, k: int) -> DataFrame:
    """The k-th highest lower bound of each query that has k candidates."""
    w = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    return bounds.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k) \
        .groupBy("query_id").agg(F.min("low").alias("tau"), F.count("*").alias("n")) \
        .select("query_id", F.when(F.col("n") == k, F.col("tau")).alias("tau"))


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, every: int = 50, scale: int = 256,
          nodes: int = 2, shard_rows: int = 2048, pack: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` highest scores."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(quantised(df, id_col, vec_col, scale).groupBy("vec_id").agg(F.min("vec").alias("vec")), "rows")
    dims = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    asked = rows.where(F.col("vec_id") % every == 0)
    alike = Window.partitionBy("vec").orderBy("vec_id")
    vecs = stored(rows.withColumn("rn", F.row_number().over(alike)).where(F.col("rn") <= k + 1).drop("rn"), "vectors")
    shards = _numbered(_packs(vecs, shard_rows, nodes, dims, n), "shards")
    asks = _numbered(_packs(asked, pack, nodes, dims, n), "asks")

    def meet(queries: DataFrame, extra: list[str]) -> DataFrame:
        """Every shard with every block of queries of its components.  The blocks are small as Parquet, so without the hint
        all pairs would be planned as a broadcast, which the driver holds."""
        return shards.join(queries.select("block", F.col("ids").alias("qids"), F.col("mat").alias("qmat"), *extra).hint("shuffle_replicate_nl"), "block")

    with batches_of(spark, PAIRS):
        local = stored(meet(asks, []).mapInPandas(_first(k), "query_id long, block int, vec_id long, part long"), "first")
    lows = local.where("vec_id is null").groupBy("query_id", "block").agg(F.min("part").alias("low"))
    floor = stored(lows.groupBy("query_id").agg(F.sum("low").alias("base"), F.map_from_entries(
        F.collect_list(F.struct("block", "low"))).alias("lows")), "floors")

    asked_for = asked.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q"))

    def resolved(pairs: DataFrame) -> DataFrame:
        """Whole scores of (query_id, vec_id) pairs, from the vectors."""
        return pairs.select("query_id", "vec_id").join(vecs, "vec_id").join(asked_for, "query_id") \
            .select("query_id", "vec_id", F.aggregate(F.zip_with("q", "vec", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long"))),
                                                      F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))

    tau1 = _kth(resolved(local.where("vec_id is not null").select("query_id", "vec_id").distinct()).withColumnRenamed("score", "low"), k)
    # least share of the cutoff above the lowest addends that some node must reach; everything, where there are fewer than k
    cuts = stored(floor.join(tau1, "query_id", "left").select(
        "query_id", F.coalesce(F.ceil((F.col("tau") - F.col("base")) / F.lit(nodes)).cast("long"), F.lit(-1)).alias("share")), "cuts")
    with_cut = stored(asks.join(_cut_arrays(asks, floor.join(cuts, "query_id")), ["shard", "block"]).drop("shard"), "cut")
    with batches_of(spark, PAIRS):
        sent = stored(meet(with_cut, ["cuts"]).mapInPandas(_second, "query_id long, block int, vec_id long, part long"), "second")
    # unknown addends are below the share, which bounds scores from above, and no less than the lowest, from below
    missing = F.lit(nodes) - F.col("m")
    known = stored(sent.groupBy("query_id", "vec_id").agg(F.sum("part").alias("known"), F.count("*").alias("m"), F.collect_list("block").alias("blocks"))
                   .join(floor.join(cuts, "query_id"), "query_id")
                   .withColumn("low", F.col("known") + F.col("base") - F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: s + F.col("lows")[b]))
                   .select("query_id", "vec_id", "known", "low", "m", (F.col("low") + missing * F.col("share")).alias("high")), "known")
    tau2 = _kth(known.select("query_id", "vec_id", "low"), k).withColumnRenamed("tau", "tau2")
    live = known.join(tau1, "query_id", "left").join(tau2, "query_id", "left") \
        .where(F.coalesce(F.col("high") >= F.greatest("tau", "tau2"), F.lit(True)))
    done = live.where(F.col("m") == nodes).select("query_id", "vec_id", F.col("known").alias("score"))
    open_ = resolved(live.where(F.col("m") < nodes))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return done.union(open_).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cut_arrays(asks: DataFrame, cuts: DataFrame) -> DataFrame:
    """For each block of queries (shard, block), its cutoffs in the order of its ids."""
    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                x = np.frombuffer(row.ids, np.int64)
                yield pd.DataFrame({"shard": row.shard, "block": row.block, "spot": np.arange(len(x)), "query_id": x})

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"shard": b["shard"], "block": b["block"], "cuts": [np.asarray(x, np.int64).tobytes() for x in b["list"]]})

    return asks.select("shard", "block", "ids").mapInPandas(ids, "shard int, block int, spot int, query_id long") \
        .join(cuts.select("query_id", "share", "lows"), "query_id") \
        .groupBy("shard", "block").agg(F.sort_array(F.collect_list(F.struct("spot", (F.col("lows")[F.col("block")] + F.col("share")).alias("cut")))).alias("list")) \
        .select("shard", "block", F.col("list.cut").alias("list")).mapInPandas(join_up, "shard int, block int, cuts binary")
