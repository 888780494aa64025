"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

The test items are the indexed side.  Their terms, document frequencies and
BM25 impacts are computed in Spark; an impact is divided by its item's score
against itself, so that a passage holding all of an item scores 1.  Postings
are cut into blocks of items with the largest impact of each term in each
block.

Every training text is cut into passages of ``2 * stride`` words, one every
``stride`` words (at least as many as the longest item has, so some passage
holds all of an item that a text holds).  A passage retrieves *all* items
that score ``threshold`` or more.  Terms too common to lift any item to the
threshold among themselves are non-essential: only passages with essential
terms are looked at, a block only where the summed block maxima of its
essential terms plus the block's largest non-essential sum reach the
threshold, and only items of such blocks are scored.

A retrieved item is verified in the passage and its neighbours: of its
question and of its answer at least ``overlap`` of the five-word shingles
must occur (of fewer than five words: all as one).  Without a column for the
answer, the last third of an item's words is taken as the answer.  That cut is
made up; with ``whole`` an item cut so is also taken when ``overlap`` of the
five-word shingles of the uncut item occur, those over the cut included.

The index goes to the executors by broadcast, behind a check: items beyond
``shard_chars`` characters are dealt to several index shards, each of which
meets all texts in its own pass.

Words are runs of letters, digits and non-ASCII characters in lower case.
Null and empty texts have no leaks; items without words or without an id take
no part; repeated items count once.  Repeated rows, null ids and extra
columns of the texts pass unchanged; a column ``leaks`` is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAK = "item_id long, score double, question_overlap double, answer_overlap double"
# Lower case and word characters, by byte: bytes beyond ASCII belong to words.
_BYTES = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_BYTES).split() if text else []


def shingles(ws: list[bytes], size: int = 5) -> set[bytes]:
    return {b" ".join(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


class Index:
    """Impacts of a shard's items, in blocks."""

    def __init__(self, items: list[tuple[int, list[bytes], int, bool]], impacts: list[dict[bytes, float]], common: dict[bytes, int],
                 threshold: float, overlap: float, stride: int, block: int = 8):
        """``items``: id, words, number of question words, whether uncut shingles count too; ``common``: items of the whole benchmark that hold a term."""
        self.items, self.threshold, self.overlap, self.stride, self.block = items, threshold, overlap, stride, block
        self.terms = {t: i for i, t in enumerate(sorted({t for m in impacts for t in m}))}
        self.impacts = [{self.terms[t]: w for t, w in m.items()} for m in impacts]
        self.parts = [(shingles(ws[:q]), shingles(ws[q:])) + ((shingles(ws),) if uncut else ()) for _, ws, q, uncut in items]
        by_term = defaultdict(list)
        for i, m in enumerate(self.impacts):
            for t, w in m.items():
                by_term[t].append((i, w))
        # non-essential: the most common terms, as long as no item reaches the threshold by them alone
        light = np.zeros(len(items))
        self.essential = np.ones(len(self.terms), bool)
        name = list(self.terms)
        for t in sorted(by_term, key=lambda t: (-common[name[t]], t)):
            more = light.copy()
            for i, w in by_term[t]:
                more[i] += w
            if more.max(initial=0) >= threshold - 1e-9:
                break
            light = more
            self.essential[t] = False
        n = -(-len(items) // block)
        self.light = np.array([light[b * block:(b + 1) * block].max() for b in range(n)])
        # block maxima of essential terms, as rows by term
        rows = [(t, b, max(w for i, w in by_term[t] if i // block == b)) for t in sorted(by_term) if self.essential[t]
                for b in sorted({i // block for i, _ in by_term[t]})]
        self.row_block = np.array([r[1] for r in rows], np.int64)
        self.row_max = np.array([r[2] for r in rows], float)
        count = np.bincount([r[0] for r in rows], minlength=len(self.terms)) if rows else np.zeros(len(self.terms), int)
        self.row_start = np.concatenate(([0], np.cumsum(count)))
        # essential postings item by item, and each item's non-essential sum
        posts = [(t, i, w) for t in sorted(by_term) if self.essential[t] for i, w in by_term[t]]
        self.post_item = np.array([r[1] for r in posts], np.int64)
        self.post_impact = np.array([r[2] for r in posts], float)
        count = np.bincount([r[0] for r in posts], minlength=len(self.terms)) if posts else np.zeros(len(self.terms), int)
        self.post_start = np.concatenate(([0], np.cumsum(count)))
        self.item_light = light

    def candidates(self, ids: np.ndarray, passage_of: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Pairs (passage, item) that can reach the threshold.

        ``ids``: term of each word (-1: none); ``passage_of``: the later passage of a word, which the one before shares
        unless ``last`` says that it is its text's first.
        """
        hit = np.flatnonzero((ids >= 0) & self.essential[ids])
        if not len(hit) or not len(self.row_max):
            return np.zeros((0, 2), np.int64)
        two = hit[~last[hit]]
        pair = np.unique(np.concatenate((passage_of[hit], passage_of[two] - 1)) * len(self.terms) + np.concatenate((ids[hit], ids[two])))
        passage, term = np.divmod(pair, len(self.terms))
        # blocks by the sums of their terms' maxima
        row, at = _spread(self.row_start, term)
        key, bound = _summed(passage[row] * len(self.light) + self.row_block[at], self.row_max[at])
        key = key[bound + self.light[key % len(self.light)] >= self.threshold - 1e-9]
        if not len(key):
            return np.zeros((0, 2), np.int64)
        # items of those blocks by their own essential impacts
        some = np.isin(passage, key // len(self.light))
        passage, term = passage[some], term[some]
        row, at = _spread(self.post_start, term)
        item = self.post_item[at]
        inside = np.isin(passage[row] * len(self.light) + item // self.block, key)
        key, bound = _summed(passage[row[inside]] * len(self.items) + item[inside], self.post_impact[at[inside]])
        return np.column_stack(np.divmod(key[bound + self.item_light[key % len(self.items)] >= self.threshold - 1e-9], len(self.items)))

    def leaks(self, texts: list[str | None]) -> list[list[tuple]]:
        """Verified items of each text: id, best score, overlaps."""
        out = [[] for _ in texts]
        cut = [words(t) for t in texts]
        sizes = np.array([len(c) for c in cut])
        total = int(sizes.sum())
        if not total or not self.items:
            return out
        ids = np.fromiter((i for c in cut for i in map(self.terms.get, c, repeat(-1))), np.int64, total)
        start = np.concatenate(([0], np.cumsum(sizes)))
        inside = np.arange(total) - np.repeat(start[:-1], sizes)
        first = np.concatenate(([0], np.cumsum(-(-sizes // self.stride))))  # a text's first passage
        passage = np.repeat(first[:-1], sizes) + inside // self.stride
        found: dict[tuple[int, int], float] = {}
        spots: dict[tuple[int, int], list[int]] = defaultdict(list)
        seen: tuple[int, set[int]] = (-1, set())
        for p, i in self.candidates(ids, passage, inside < self.stride).tolist():
            text = int(np.searchsorted(first, p, side="right") - 1)
            at = (p - int(first[text])) * self.stride
            if seen[0] != p:
                seen = (p, set(ids[start[text] + at:start[text] + min(at + 2 * self.stride, int(sizes[text]))].tolist()))
            score = sum(w for t, w in self.impacts[i].items() if t in seen[1])
            if score >= self.threshold - 1e-9:
                found[text, i] = max(found.get((text, i), 0.0), score)
                spots[text, i].append(at)
        for (text, i), score in sorted(found.items()):
            best, whole = (0.0, 0.0), 0.0
            for at in spots[text, i]:
                near = shingles_of(cut[text][max(0, at - self.stride):at + 3 * self.stride], self.parts[i])
                q, a, *uncut = (len(x & y) / len(x) if x else 1.0 for x, y in zip(self.parts[i], near))
                best, whole = max(best, (q, a), key=min), max(whole, *uncut, 0.0)
            if max(min(best), whole) >= self.overlap:
                out[text].append((self.items[i][0], float(score), *best))
        return out


def _spread(start: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The postings of each term: which term's they are, and where."""
    count = start[term + 1] - start[term]
    row = np.repeat(np.arange(len(term)), count)
    return row, start[term][row] + np.arange(len(row)) - (np.cumsum(count) - count)[row]


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(key, return_inverse=True)
    return unique, np.bincount(inverse, value, len(unique))


def shingles_of(ws: list[bytes], parts: tuple[set[bytes], ...]) -> list[set[bytes]]:
    """For each part the shingles of its own length (a short part is one shingle)."""
    sizes = [next(iter(p)).count(b" ") + 1 if p else 1 for p in parts]
    return [{b" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)} for n in sizes]


def indexes(benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.8, stride: int = 64, k1: float = 1.2, b: float = 0.75,
            id_col: str = "item_id", text_col: str = "text", answer_col: str | None = None, shard_chars: int = 1 << 24, whole: bool = False) -> list[Index]:
    """Index shards of at most about ``shard_chars`` characters of items."""
    @F.pandas_udf("array<binary>")
    def cut(text: pd.Series) -> pd.Series:
        return pd.Series([words(t) for t in text])

    question, answer = F.col(text_col).cast("string"), F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), question.alias("question"), answer.alias("answer")).distinct() \
        .where("item_id is not null").withColumns({"q": cut("question"), "a": cut("answer")})
    n_q = F.when(F.col("answer").isNull(), F.size("q") - F.ceil(F.size("q") / 3)).otherwise(F.size("q")).cast("int")
    items = items.select("item_id", n_q.alias("n_q"), F.concat("q", "a").alias("words")).where(F.size("words") > 0) \
        .withColumn("item", F.struct("item_id", "n_q", "words"))
    n, mean, longest, chars = items.agg(F.count("*"), F.avg(F.size("words")), F.max(F.size("words")),
                                        F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w) + 1))).first()
    if not n:
        return []
    tf = items.select("item", F.explode("words").alias("term")).groupBy("item", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.size("item.words") / mean))
    weighted = tf.join(df, "term").groupBy("item").agg(F.collect_list(F.struct("term", impact.alias("w"), "df")).alias("terms"))
    shards = -(-chars // shard_chars)
    out = []
    for s in range(shards):  # one shard of bounded size at a time comes to the driver
        rows = weighted.where(F.pmod(F.xxhash64("item.item_id"), F.lit(shards)) == s).orderBy("item").collect()
        impacts, common = [], {}
        for r in rows:
            own = sum(t.w for t in r.terms)
            impacts.append({bytes(t.term): t.w / own for t in sorted(r.terms, key=lambda t: bytes(t.term))})
            common.update((bytes(t.term), t.df) for t in r.terms)
        found = [(r.item.item_id, [bytes(w) for w in r.item.words], r.item.n_q, whole and answer_col is None) for r in rows]
        out.append(Index(found, impacts, common, threshold, overlap, max(stride, longest)))
    return out


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", group: int = 512, **settings) -> DataFrame:
    """``docs`` with ``leaks``, the array of benchmark items that the text holds (see the module's text)."""
    kind = f"array<struct<{', '.join(c.replace(' ', ':') for c in LEAK.split(', '))}>>"
    names = [c.split()[0] for c in LEAK.split(", ")]

    def finder(index):
        def find(text: pd.Series) -> pd.Series:
            out = []
            for i in range(0, len(text), group):
                out += [[dict(zip(names, x)) for x in found] for found in index.value.leaks(text.iloc[i:i + group].tolist())]
            return pd.Series(out, dtype=object)

        return F.pandas_udf(find, kind)

    text = F.col(text_col).cast("string")
    columns = [finder(docs.sparkSession.sparkContext.broadcast(shard))(text) for shard in indexes(benchmark, **settings)]
    return docs.withColumn("leaks", F.concat(F.array().cast(kind), *columns))


def leak_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row for each text and benchmark item it holds."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_leaks(slim, benchmark, **settings).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
