"""SimHash near-duplicates: fingerprints, shard BK-trees, components.

Texts become 64-bit fingerprints in Arrow batches.  Distinct fingerprints are
dealt to shards so that any two within the radius meet: the 64 bits are cut
into ``radius + spare`` blocks, at most ``radius`` of which can differ, so two
such fingerprints agree on some choice of ``spare`` blocks; each choice is a
key.  The fingerprints of a key form BK-trees (children keyed by their integer
Hamming distance to the parent) and are looked up in them, following only
edges within the radius of the distance at hand.  A key with more than
``shard_rows`` fingerprints becomes several trees and several query shards,
each pair of which is a unit of work of its own, so no task holds an
unbounded key.  All trees of a task are built and searched together, level by
level, as numpy arrays.  Only a spanning star of each tree's links leaves the
task; components of those are those of all links.

Null and empty texts have fingerprint zero and are linked like any other.
Rows without an id take part with a null ``doc_id``; a component of null ids only has a null ``component_id``.
Repeated rows are returned as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import as_bytes, stored
from rankspark.llm.components import components

#: Shingles whose bits are counted at once.
STEP = 1 << 15


def simhash(data: bytes, size: int = 4, seed: int = 42) -> int:
    """Majority bits of the shingle hashes of a UTF-8 text, as a signed 64-bit number."""
    words = data.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    m = len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, m) + 1) - 1
    if m <= size:
        pairs = [(0, len(flat))]
    else:
        starts = np.concatenate(([0], ends[:m - size] + 1))
        pairs = zip(starts.tolist(), ends[size - 1:].tolist())
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(flat[a:b], seed) for a, b in pairs], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), STEP):
        bits = np.unpackbits(h[i:i + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, seed: int = 42,
                 mark: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed 64-bit) and, where asked for, ``mark``, a hash of the text as it is."""
    @F.pandas_udf("long")
    def fp(data: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, size, seed) for x in data], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), fp(as_bytes(text_col)).alias("fp"),
                       *([F.xxhash64(as_bytes(text_col)).alias("mark")] if mark else []))


def block_keys(radius: int, spare: int) -> list[tuple[int, list[int]]]:
    """The 64-bit masks, one for each choice of ``spare`` of ``radius + spare`` bit blocks."""
    n = radius + spare
    cuts = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(n)]
    return [sum(c) for c in combinations(blocks, spare)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class Forest:
    """BK-trees, one for each group, as arrays: ``child[node, distance]`` is a node or -1."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        """``group`` is ascending; a group's first fingerprint is its root."""
        n = len(fp)
        self.fp = fp
        self.child = np.full((n, 65), -1, np.int32)
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if n else np.array([], int)
        self.root_of, self.root = group[first], first
        at = np.repeat(first, np.diff(np.concatenate((first, [n]))))
        todo = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = at[todo]
        while len(todo):
            dist = np.bitwise_count(fp[todo] ^ fp[at]).astype(np.int64)
            slot = at.astype(np.int64) * 65 + dist
            # the first of those that reach an empty edge becomes its node, the others descend to it
            key, where = np.unique(slot, return_index=True)
            self.child.reshape(-1)[key] = todo[where]
            stay = np.ones(len(todo), bool)
            stay[where] = False
            at = self.child.reshape(-1)[slot][stay]
            todo = todo[stay]

    def within(self, group: np.ndarray, fp: np.ndarray, radius: int, step: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query number, node) at ``radius`` or less, in blocks of queries."""
        spot = np.searchsorted(self.root_of, group)
        spot[spot == len(self.root_of)] = 0
        has = np.flatnonzero(self.root_of[spot] == group) if len(self.root_of) else np.array([], int)
        for i in range(0, len(has), step):
            q = has[i:i + step]
            node = self.root[spot[q]]
            while len(q):
                dist = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
                near = dist <= radius
                if near.any():
                    yield q[near], node[near]
                edge = dist[:, None] + np.arange(-radius, radius + 1)
                ok = (edge >= 0) & (edge <= 64)
                nxt = np.where(ok, self.child[node[:, None], np.clip(edge, 0, 64)], -1)
                row, col = np.nonzero(nxt >= 0)
                q, node = q[row], nxt[row, col]


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest number linked to each of ``n``, by hooking and pointer jumping."""
    up = np.arange(n)
    if not pairs:
        return up
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    while True:
        ra, rb = up[a], up[b]
        live = ra != rb
        if not live.any():
            return up
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt


def _linked(part: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning links of whole groups; ``side`` 0 is a node, 1 a query, 2 both."""
    group = part["unit"].to_numpy()
    fp = part["fp"].to_numpy().view(np.uint64)
    side = part["side"].to_numpy()
    _, group = np.unique(group, return_inverse=True)
    order = np.argsort(group, kind="stable")
    group, fp, side = group[order], fp[order], side[order]
    tree, ask = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    forest = Forest(group[tree], fp[tree])
    pairs, held, up = [], 0, np.arange(len(fp))
    for q, node in forest.within(group[ask], fp[ask], radius):
        pairs.append((ask[q], tree[node]))
        held += len(q)
        if held > 1 << 20:  # fold what has come so far, so that pairs don't pile up
            up = _roots(len(fp), [*pairs, (np.arange(len(fp)), up)])
            pairs, held = [], 0
    up = _roots(len(fp), [*pairs, (np.arange(len(fp)), up)])
    far = up != np.arange(len(fp))
    signed = fp.view(np.int64)
    return pd.DataFrame({"u": signed[far], "v": signed[up[far]]})


def links(fps: DataFrame, radius: int = 4, spare: int = 2, shard_rows: int = 2048) -> DataFrame:
    """``fps(fp)``, distinct -> links ``(u, v)`` that span the components of all pairs within ``radius``."""
    masks = block_keys(radius, spare)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long"))) for i, m in enumerate(masks)])
    dealt = fps.select("fp", F.explode(keys).alias("key"))
    many = dealt.groupBy("key").count().where("count > 1").withColumn("s", F.ceil(F.col("count") / F.lit(shard_rows)).cast("int"))
    met = dealt.join(many.select("key", "s"), "key")
    own = F.pmod(F.xxhash64("fp", F.lit("shard")), F.col("s")).cast("int")
    every = F.sequence(F.lit(0), F.col("s") - 1)
    # unit (key, t, q): the tree of shard t asked by shard q; for t = q the same rows are both
    roles = F.when(F.col("s") == 1, F.array(F.struct(F.lit(0).alias("t"), F.lit(0).alias("q"), F.lit(2).alias("side")))).otherwise(
        F.flatten(F.transform(every, lambda o: F.when(
            o == F.col("own"), F.array(F.struct(o.alias("t"), o.alias("q"), F.lit(2).alias("side")))).when(
            o > F.col("own"), F.array(F.struct(F.col("own").alias("t"), o.alias("q"), F.lit(0).alias("side")))).otherwise(
            F.array(F.struct(o.alias("t"), F.col("own").alias("q"), F.lit(1).alias("side")))))))
    units = met.withColumn("own", own).select("fp", "key", F.explode(roles).alias("r")) \
        .select("fp", F.xxhash64("key", "r.t", "r.q").alias("unit"), F.col("r.side").alias("side"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += len(b)
            if rows < 1 << 17:
                continue
            all_ = pd.concat(held, ignore_index=True)
            last = all_["unit"].iloc[-1]
            whole = all_["unit"] != last  # sorted: the last unit may go on in the next batch
            held, rows = [all_[~whole]], int((~whole).sum())
            if whole.any():
                yield _linked(all_[whole], radius)
        if held and rows:
            yield _linked(pd.concat(held, ignore_index=True), radius)

    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, "unit").sortWithinPartitions("unit").mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4,
                    seed: int = 42, mark: bool = False) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document (see the module's text), and ``mark`` where asked for."""
    per_doc = stored(fingerprints(docs, id_col, text_col, size, seed, mark), "simhash")
    fps = stored(per_doc.groupBy("fp").agg(F.min("doc_id").alias("low")), "fps")
    roots = components(links(fps, radius))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(lowest, "root").select("fp", "component_id")
    return per_doc.join(of, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                                                     *(["mark"] if mark else []))
