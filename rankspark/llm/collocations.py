"""Phrase collocations, counted in quotient filters.

A phrase is 2 to ``longest`` words in a row within a piece of a text; all
counts are per language.  Candidates occur ``least`` times or more.  A
candidate's score is that of its worst cut in two, a n / (l r) in thousandths,
rounded down.  Candidates inside a longer one that occurs (nearly) as often
are dropped, the others are ranked by score.

* Word ids.  Words are counted by a map-side combined aggregate.  An id is a
  64-bit hash of word and language; the table of all words shows that no two
  share one (else they are counted with another seed; within a task a second
  hash is compared), so ids stand for words, need no dictionary in the tasks, and imply the language.  A bit table of fixed
  size of the ids that occur ``least`` times or more is broadcast: other words
  break a phrase (those it passes wrongly only cost time).
* Filters.  The n ids of a phrase are packed into a key of 64 n bits.  An
  invertible permutation spreads it; its first bits are the quotient, all
  others the remainder.  A filter holds the remainders by quotient, in order,
  with counters of a byte that go over into eight where needed.  Quotient and
  remainder give back the key, so counts are exact and phrases are read out of
  the filter.
* Shards.  A task counts its texts in a filter of bounded size.  When it is
  full, and at the end, it goes out in pages, ranges of quotients that the
  permutation fills evenly however frequent a phrase is.  The pages of a range
  meet in one task, which merges the sorted filters and keeps the counts of
  ``least`` or more.
* Levels.  A phrase of n words can only be a candidate if both phrases of
  n - 1 words in it are, so each level counts only where the bit table of the
  level before (of fixed size, broadcast) lets it.

Parts of a candidate occur at least as often as it does, so they are
candidates or frequent words and their counts are known; likewise it is
enough to look at the candidates one word longer to find one that holds it.

Null texts are empty, a null language is ``und``.  Repeated rows count each
time; ids and extra columns are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm.common import as_bytes, discard, stored
from rankspark.llm.rolling import Words, bit_table, byte_set, grouped, in_table

#: What ends a piece, and what separates words.
BREAKS = byte_set(b".,;:!?\n\x0b\x0c\r")
SPACES = BREAKS | byte_set(b" \t")
#: Keys counted at once, keys that a task's filter holds before it goes out, bytes of texts counted at once, and groups of them.
BUFFER, FULL, GROUP, GROUPS = 1 << 19, 1 << 20, 1 << 18, 64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_I1, _I2 = (np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M2))


def _spread(x: np.ndarray) -> np.ndarray:
    """An invertible mix of 64 bits (splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


def _gathered(x: np.ndarray) -> np.ndarray:
    """``_spread`` undone."""
    x = (x ^ x >> np.uint64(31) ^ x >> np.uint64(62)) * _I2
    x = (x ^ x >> np.uint64(27) ^ x >> np.uint64(54)) * _I1
    return x ^ x >> np.uint64(30) ^ x >> np.uint64(60)


def _rest(tail: np.ndarray) -> np.ndarray:
    out = np.zeros(len(tail), np.uint64)
    for i in range(tail.shape[1]):
        out = _spread(out + tail[:, i] + np.uint64(i + 1))
    return out


def permuted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ids (rows of n words of 64 bits) -> first 64 bits and the others of the permuted key."""
    return _spread(ids[:, 0] ^ _rest(ids[:, 1:])), ids[:, 1:]


def restored(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    return np.column_stack((_gathered(head) ^ _rest(tail), tail))


class QuotientFilter:
    """Counts of permuted keys, by quotient (``8 * skip`` bits) and remainder."""

    def __init__(self, head: np.ndarray, tail: np.ndarray, count: np.ndarray):
        """Keys in any order; those that repeat are added up."""
        order = np.argsort(head, kind="stable")  # merges runs that are sorted already
        head, tail, count = head[order], tail[order], count[order]
        same = head[1:] == head[:-1]
        if (tail[1:][same] != tail[:-1][same]).any():  # one head, several keys
            order = np.lexsort((*tail.T[::-1], head))
            head, tail, count = head[order], tail[order], count[order]
            same = head[1:] == head[:-1]
        same[same] = (tail[1:][same] == tail[:-1][same]).all(axis=1)
        first = np.flatnonzero(np.concatenate(([True], ~same))) if len(head) else np.zeros(0, np.int64)
        head, self.tail = head[first], tail[first]
        total = np.add.reduceat(count, first) if len(first) else count
        self.skip = 2 if len(head) >= 1 << 12 else 1
        quotient = (head >> np.uint64(64 - 8 * self.skip)).astype(np.int64)
        self.least = int(quotient[0]) if len(head) else 0
        self.ends = np.cumsum(np.bincount(quotient - self.least)).astype("<u4") if len(head) else np.zeros(0, "<u4")
        self.remainder = head.astype(">u8").view(np.uint8).reshape(-1, 8)[:, self.skip:]
        self.small = np.minimum(total, 255).astype(np.uint8)
        self.large = total[total >= 255].astype("<i8")

    def __len__(self) -> int:
        return len(self.small)

    def heads(self) -> np.ndarray:
        out = np.zeros((len(self), 8), np.uint8)
        out[:, self.skip:] = self.remainder
        quotient = self.least + np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=np.uint32(0)).astype(np.int64))
        return out.view(">u8").reshape(-1).astype(np.uint64) | quotient.astype(np.uint64) << np.uint64(64 - 8 * self.skip)

    def counts(self) -> np.ndarray:
        out = self.small.astype(np.int64)
        out[self.small == 255] = self.large
        return out

    def to_bytes(self) -> bytes:
        sizes = struct.pack("<BBIIII", self.skip, self.tail.shape[1], self.least, len(self.ends), len(self), len(self.large))
        return b"".join((sizes, self.ends.tobytes(), self.remainder.tobytes(), self.tail.astype("<u8").tobytes(), self.small.tobytes(), self.large.tobytes()))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        self = cls.__new__(cls)
        self.skip, n, self.least, quotients, m, large = struct.unpack_from("<BBIIII", data)
        at = struct.calcsize("<BBIIII")

        def take(kind: str, size: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, size, at)
            at += out.nbytes
            return out

        self.ends = take("<u4", quotients)
        self.remainder = take("u1", m * (8 - self.skip)).reshape(m, 8 - self.skip)
        self.tail = take("<u8", m * n).reshape(m, n)
        self.small, self.large = take("u1", m), take("<i8", large)
        return self

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        return cls(*(np.concatenate([getattr(f, name)() if name != "tail" else f.tail for f in filters]) for name in ("heads", "tail", "counts")))

    def pages(self, n: int) -> Iterator[tuple[int, bytes]]:
        """The filter in ``n`` equal ranges of the quotient."""
        head, count = self.heads(), self.counts()
        page = (head >> np.uint64(32)).astype(np.int64) * n >> 32
        for own in np.split(np.arange(len(head)), np.flatnonzero(page[1:] != page[:-1]) + 1):
            if len(own):
                yield int(page[own[0]]), QuotientFilter(head[own], self.tail[own], count[own]).to_bytes()

    def ids(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Heads, packed ids and counts of the keys that occur ``least`` times or more."""
        count = self.counts()
        some = count >= least
        head, tail = self.heads()[some], self.tail[some]
        return head, restored(head, tail), count[some]


def _names(seed: int) -> bytes:
    """Other bytes in place of all bytes: another hash."""
    return np.random.default_rng(seed).permutation(256).astype(np.uint8).tobytes()


class Ids:
    """Ids of the words of texts, in lower case, and the number of the piece of each; ids imply the text's language."""

    def __init__(self, texts: list[bytes], langs: list[str], seed: int):
        self.words = Words([t.lower() for t in texts], SPACES, _names(seed) if seed else None)
        salt = {lang: xxhash.xxh3_64_intdigest(lang.encode(), seed) for lang in set(langs)}
        own = np.fromiter((salt[lang] for lang in langs), np.uint64, len(langs))
        self.count = np.diff(self.words.first)
        self.ids = _spread(self.words.hashes ^ np.repeat(own, self.count))
        # texts are joined by a line feed, so that pieces end with them
        self.piece = np.cumsum(BREAKS[np.frombuffer(self.words.flat, np.uint8)])[self.words.start]


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``docs(lang, data)`` -> ``lang, word, id, c``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def out():
            lang, ids, word, n = (np.concatenate([x[k] for x in held]) for k in range(4))
            _, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
            if (word == word[first][inverse]).all():  # else words of one id stay apart, for the table to show
                n = np.bincount(inverse, n, len(first)).astype(np.int64)
                lang, ids, word = lang[first], ids[first], word[first]
            return pd.DataFrame({"lang": pd.Series(lang, dtype=object), "id": ids, "word": pd.Series(word, dtype=object), "n": n})

        for b in batches:
            langs, texts = b["lang"].tolist(), b["data"].tolist()
            for i, j in grouped(texts, GROUP):
                own = Ids(texts[i:j], langs[i:j], seed)
                ids, first, inverse, n = np.unique(own.ids, return_index=True, return_inverse=True, return_counts=True)
                # a second hash tells words of one id apart
                other = Words([own.words.flat], SPACES, _names(seed + (1 << 32))).hashes
                if (other != other[first][inverse]).any():
                    both, first, n = np.unique(np.column_stack((own.ids, other)), axis=0, return_index=True, return_counts=True)
                    ids = np.ascontiguousarray(both[:, 0])
                w, text = own.words, np.searchsorted(own.words.first, first, "right") - 1
                spelt = np.empty(len(first), object)
                spelt[:] = [w.flat[a:z] for a, z in zip(w.start[first].tolist(), w.stop[first].tolist())]
                held.append((np.array(langs[i:j], object)[text], ids.view(np.int64), spelt, n))
                if len(held) == GROUPS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.mapInPandas(run, "lang string, id long, word binary, n long").groupBy("lang", "word", "id").agg(F.sum("n").alias("c"))


def phrase_counts(docs: DataFrame, n: int, least: int, seed: int, words, shorter) -> DataFrame:
    """``docs(lang, data)`` -> ``h, ids, f`` of the phrases of ``n`` words that occur ``least`` times or more.

    ``words`` and ``shorter`` are broadcast bit tables: of the ids of words and, for n > 2, of the heads of phrases of n - 1 words.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keys(ids: np.ndarray) -> np.ndarray:
        """Packed ids of all phrases that can be candidates."""
        if len(ids) < n:
            return np.zeros((0, n), np.uint64)
        ok = ids != 0
        some = ok[:len(ids) - n + 1].copy()
        for i in range(1, n):
            some &= ok[i:len(ids) - n + 1 + i]
        at = np.flatnonzero(some)
        if shorter is not None and len(at):
            # both shorter phrases of a place; neighbouring places share one
            spots = np.unique(np.concatenate((at, at + 1)))
            good = in_table(shorter.value, permuted(ids[spots[:, None] + np.arange(n - 1)])[0])
            at = at[good[np.searchsorted(spots, at)] & good[np.searchsorted(spots, at + 1)]]
        return ids[at[:, None] + np.arange(n)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, waiting, size = None, [], 0

        def fold():
            head, tail = permuted(np.concatenate(waiting))
            new = QuotientFilter(head, tail, np.ones(len(head), np.int64))
            return QuotientFilter.merged([held, new]) if held is not None else new

        def out():
            return pd.DataFrame(held.pages(parts), columns=["page", "filter"])

        for b in batches:
            langs, texts = b["lang"].tolist(), b["data"].tolist()
            for i, j in grouped(texts, GROUP):
                own = Ids(texts[i:j], langs[i:j], seed)
                # a place without a word after each piece
                flat = np.zeros(len(own.ids) + 1 + (int(own.piece[-1]) if len(own.ids) else 0), np.uint64)
                flat[np.arange(len(own.ids)) + own.piece] = np.where(in_table(words.value, own.ids), own.ids, np.uint64(0))
                for a in range(0, len(flat), BUFFER):  # parts of a very long text, with the words that both hold
                    found = keys(flat[a:a + BUFFER + n - 1])
                    waiting.append(found)
                    size += len(found)
                    if size >= BUFFER:
                        held, waiting, size = fold(), [], 0
                        if len(held) >= FULL:
                            yield out()
                            held = None
        if size:
            held = fold()
        if held is not None:
            yield out()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(filters):
            head, ids, f = QuotientFilter.merged(filters).ids(least)
            return pd.DataFrame({"h": head.view(np.int64), "ids": pd.Series(list(ids.view(np.int64)), dtype=object), "f": f})

        page, held, size = None, [], 0
        for b in batches:
            for own, data in zip(b["page"], b["filter"]):
                if own != page and held:
                    yield out(held)
                    held, size = [], 0
                page = own
                held.append(QuotientFilter.from_bytes(data))
                size += len(held[-1])
                if size > max(FULL, 2 * len(held[0])):
                    held = [QuotientFilter.merged(held)]
                    size = len(held[0])
        if held:
            yield out(held)

    return docs.mapInPandas(count, "page int, filter binary").repartition(parts, "page").sortWithinPartitions("page") \
        .mapInPandas(merge, "h long, ids array<long>, f long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5, share: int = 100,
                 top: int | None = 2000, filter_bits: int = 27) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases (None: all).

    ``share``: a candidate is dropped where one that holds it has this percentage of its count or more.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), as_bytes(text_col).alias("data"))
    seed = 0
    while True:
        vocabulary = stored(word_counts(texts, seed), "vocabulary")
        if vocabulary.groupBy("id").count().where("count > 1 or id = 0").isEmpty():
            break
        discard(spark, [vocabulary])
        seed += 1
    frequent = vocabulary.where(F.col("c") >= least)
    words = spark.sparkContext.broadcast(bit_table(frequent.select(F.col("id").alias("h")), filter_bits))
    levels, shorter = [], None
    for n in range(2, longest + 1):
        levels.append(stored(phrase_counts(texts, n, least, seed, words, shorter), "phrases"))
        if n < longest:
            shorter = spark.sparkContext.broadcast(bit_table(levels[-1].select("h"), filter_bits))
    candidates = levels[0].select("ids", "f")
    for more in levels[1:]:
        candidates = candidates.unionByName(more.select("ids", "f"))
    known = candidates.unionByName(frequent.select(F.array("id").alias("ids"), F.col("c").alias("f")))

    # candidates in one that is a word longer
    wide = F.size("ids")
    inner = candidates.where(wide > 2).select("f", F.explode(F.array(F.slice("ids", 1, wide - 1), F.slice("ids", 2, wide - 1))).alias("ids")) \
        .groupBy("ids").agg(F.max("f").alias("longer"))
    kept = candidates.join(inner, "ids", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * share)) \
        .select("ids", F.col("f").alias("a"))
    # the words of each phrase; the language is that of any of them
    spelt = kept.select("ids", "a", F.posexplode("ids").alias("at", "id")).join(frequent.select("id", "lang", "word"), "id") \
        .groupBy("ids").agg(F.first("a").alias("a"), F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")) \
        .select("ids", "a", "lang", F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ").alias("phrase"))
    totals = vocabulary.groupBy("lang").agg(F.sum("c").alias("n"))
    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), wide - 1)).alias("k")) \
        .withColumns({"first": F.slice("ids", 1, F.col("k")), "rest": F.slice("ids", F.col("k") + 1, wide - F.col("k"))})
    cuts = cuts.join(known.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first") \
        .join(known.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    # a and n are the same for all cuts: the lowest floor(1000 a n / (l r)) needs the language's n first
    scored = cuts.join(spelt.select("ids", "lang", "phrase"), "ids").join(totals, "lang").withColumn("score", thousandths("a", "n", "l", "r"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("b.a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    out = stored(ranked.select("lang", "rank", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score"), "collocations")
    discard(spark, [vocabulary, *levels])
    return out


def thousandths(a: str, n: str, left: str, right: str):
    """floor(1000 a n / (l r)), exact while the products stay below 10 ** 38."""
    wide = [F.col(c).cast("decimal(17,0)") for c in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3]).cast("long")
