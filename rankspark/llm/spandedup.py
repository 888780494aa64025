"""Word-span dedup by suffix automata of reference shards.

Removes each word covered by a window of ``length`` words whose sequence also
starts in a document with a smaller id.  Words are compared unchanged.

* Reference.  A text that shares no window with another needs no automaton.
  In every window the gram of ``GRAM`` words with the smallest hash is chosen,
  alike in equal windows; the windows of one gram's place are a stretch of the
  text.  A window holds half of its other words before the gram, or half of
  them after it; hashes of such halves with the gram are shuffled and counted,
  and a bit table of fixed size (``filter_bits``) of those met twice is
  broadcast.  Only windows with their bit go on (wrongly passed ones cost
  time, nothing else).  Equal stretches are one reference row with the
  smallest id of a document that holds it.  A row's *core* is what all windows
  of its kind have in common, at first the gram; cores of one document only
  are dropped.
* Shards.  Reference rows are dealt by core, so that a window finds all its
  other occurrences in its own shard; a shard is as many whole cores as have
  ``shard_words`` words.
* Automata.  A task builds the suffix automaton of a shard (of all its rows,
  ends of rows apart), each state with the smallest document id among its end
  positions, and streams the stretches through it.  The matching statistic is
  kept at ``length`` at most: where it reaches that, the state's smallest id
  is the first document of the window that ends there.
* Removal.  Every place of a stretch takes the windows that a smaller id than
  its own has; maximal runs of covered words leave the text.

An automaton goes to the task that streams what can match it, not to all
tasks: the reference grows with the input, so that a broadcast variable would
have no bound.  A core with more than ``shard_words`` words of different
stretches (a line that very many documents hold, in as many surroundings) is
split: the windows of a stretch are halved by where the gram lies in them,
and the words that all windows of a half hold are a longer core.  Cores of
one document drop out again and equal stretches become one; a core as long as
the window has one stretch, so there are ``log2(length)`` rounds at most.

Stretches are taken as equal by 128 bits of hashes; windows of different
stretches are compared word by word.

Null texts have no words.  Rows without an id keep all words and are no
source.  Rows of equal id aren't sources for each other; rows of an id with
several texts are told apart by a hash of the text.  Extra columns are not
used or pass unchanged (``cut_spans``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import as_bytes, discard, release, stored
from rankspark.llm.rolling import MARGIN, Words, bit_table, grouped, in_table, sampled, spans

#: Words of a sampled gram.
GRAM = 5
#: ``lo``: the first of ``n`` windows, ``j``: its words before the gram, from ``a`` to ``z`` for any window of the core.
PLACE = "h long, x long, doc_id long, mark long, lo long, n int, j int, a int, z int, words binary"


class Automaton:
    """Suffix automaton of several sequences; a state's ``low`` is the smallest number given with a sequence that ends there."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.low = [-1], [0], [1 << 62]
        self.closed = False

    def _state(self, follow: dict, size: int, link: int, low: int) -> int:
        self.next.append(follow)
        self.size.append(size)
        self.link.append(link)
        self.low.append(low)
        return len(self.size) - 1

    def add(self, symbols: list, low: int) -> None:
        follow, link, size, lows = self.next, self.link, self.size, self.low
        last = 0
        for c in symbols:
            known = follow[last].get(c)
            if known is not None and size[known] == size[last] + 1:
                last = known  # the sequence goes along an older one
            else:
                at, new = last, -1
                if known is None:
                    new = self._state({}, size[last] + 1, 0, 1 << 62)
                    while at >= 0 and c not in follow[at]:
                        follow[at][c] = new
                        at = link[at]
                    known = follow[at][c] if at >= 0 else 0
                if at < 0 or size[known] == size[at] + 1:
                    tip = known
                else:  # longer strings reach it too: the shorter ones get their own state
                    tip = self._state(dict(follow[known]), size[at] + 1, link[known], lows[known])
                    link[known] = tip
                    while at >= 0 and follow[at].get(c) == known:
                        follow[at][c] = tip
                        at = link[at]
                if new >= 0:
                    link[new] = tip
                    last = new
                else:
                    last = tip
            if low < lows[last]:
                lows[last] = low
        self.closed = False

    def close(self) -> None:
        """Carry each state's number to those of its suffixes."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[s]
            if self.low[s] < self.low[up]:
                self.low[up] = self.low[s]
        self.closed = True

    def lows(self, symbols: list, length: int) -> list[int | None]:
        """For each window of ``length`` symbols the smallest number among the sequences that hold it (None: no one)."""
        follow, link, size, low = self.next, self.link, self.size, self.low
        state, matched, out = 0, 0, []
        for i, c in enumerate(symbols):
            while state and c not in follow[state]:
                state = link[state]
                matched = size[state]
            to = follow[state].get(c)
            if to is not None:
                state = to
                matched += 1
            if matched >= length:
                matched = length
                while size[link[state]] >= length:
                    state = link[state]
            if i >= length - 1:
                out.append(low[state] if matched == length else None)
        return out


def _cut(words: bytes, first: int, n: int) -> bytes:
    return b" ".join(words.split(b" ")[first:first + n])


def first_holders(rows: pd.DataFrame, length: int) -> list[list[int]]:
    """For each row of a shard (``words``, ``low``) the first document of each of its windows."""
    shard = Automaton()
    cut = [w.split(b" ") for w in rows["words"]]
    for words, low in zip(cut, rows["low"].tolist()):
        shard.add(words, low)
    shard.close()
    return [shard.lows(words, length) for words in cut]


class _Halves:
    """The places of texts, and for each the hash of half a window before its gram and after it (0: no window holds it)."""

    def __init__(self, texts: list[bytes], length: int):
        self.words = Words(texts)
        first = self.words.first
        p, lo, hi, self.gram, left, right = sampled(self.words.hashes, length, GRAM)
        self.text = np.searchsorted(first, p, "right") - 1
        # no window goes over a text's end
        self.p, self.lo, self.hi = p, np.maximum(lo, first[self.text]), np.minimum(hi, first[self.text + 1] - length)
        half = (length - GRAM) // 2
        some = self.lo <= self.hi
        self.left = np.where(some & (p - self.lo >= half), left, np.uint64(0))
        self.right = np.where(some & (p - self.hi <= length - GRAM - half), right, np.uint64(0))


def _places(docs: DataFrame, length: int, filter_bits: int) -> DataFrame:
    """Stretches of windows that can be shared in ``docs(doc_id, mark, data)``; ``words`` only once in a while for equal ones."""
    half = (length - GRAM) // 2

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["data"].tolist()
            for i, j in grouped(texts):
                own = _Halves(texts[i:j], length)
                h, text = np.concatenate((own.left, own.right)), np.concatenate((own.text, own.text))
                order = np.lexsort((text, h))
                h, text = h[order], text[order]
                new = (h != 0) & np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1]))) if len(h) else h != 0
                value, count = np.unique(h[new], return_counts=True)
                # a hash of several texts of the batch counts twice, which is enough
                yield pd.DataFrame({"h": np.repeat(value, np.minimum(count, 2)).view(np.int64)})

    spark = docs.sparkSession
    shared = stored(docs.select("data").mapInPandas(hashes, "h long").groupBy("h").count().where("count > 1").select("h"), "halves")
    table = spark.sparkContext.broadcast(bit_table(shared, filter_bits))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, seen = b["data"].tolist(), set()
            for i, j in grouped(texts):
                own = _Halves(texts[i:j], length)
                left, right = ((h != 0) & in_table(table.value, h) for h in (own.left, own.right))
                some = np.flatnonzero(left | right)
                left, right, p, text = left[some], right[some], own.p[some], own.text[some]
                # windows that hold only a half met once go
                lo = np.where(left, own.lo[some], np.maximum(own.lo[some], p - (length - GRAM - half)))
                hi = np.where(right, own.hi[some], np.minimum(own.hi[some], p - half))
                order = np.argsort(lo, kind="stable")
                x = np.zeros(len(lo), np.uint64)
                x[order] = spans(own.words.hashes, lo[order], hi[order] + length)
                h, x = own.gram[some].view(np.int64), x.view(np.int64)
                words = np.full(len(h), None, object)
                for k in np.unique(np.column_stack((h, x)), axis=0, return_index=True)[1].tolist():
                    key = int(h[k]), int(x[k])
                    if key not in seen:
                        seen.add(key)
                        words[k] = own.words.joined(int(lo[k]), int(hi[k]) + length)
                yield pd.DataFrame({"h": h, "x": x, "doc_id": b["doc_id"].to_numpy()[i:j][text], "mark": b["mark"].to_numpy()[i:j][text],
                                    "lo": lo - own.words.first[text], "n": hi - lo + 1, "j": p - lo, "a": 0, "z": length - GRAM, "words": words})

    return docs.select("doc_id", "mark", "data").mapInPandas(places, PLACE)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _halves(rows: DataFrame, length: int) -> DataFrame:
    """Each place as two, of its windows with many and with few words before the gram, under their longer cores."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, mark, lo, n, j, a, z, words in zip(*(b[c] for c in ("doc_id", "mark", "lo", "n", "j", "a", "z", "words"))):
                mid = (a + z + 1) // 2
                for low, high in ((mid, z), (a, mid - 1)):
                    top, end = min(j, high), max(j - n + 1, low)
                    if low <= high and top >= end:
                        own = _cut(words, j - top, length + top - end)
                        core = _cut(words, j - low, length - high + low)
                        out.append((_signed(xxhash.xxh3_64_intdigest(core, (low << 16) + high)), _signed(xxhash.xxh3_64_intdigest(own)), doc, mark,
                                    lo + j - top, top - end + 1, top, low, high, own))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PLACE.split(", ")])

    return rows.select("doc_id", "mark", "lo", "n", "j", "a", "z", "words").mapInPandas(run, PLACE)


def repeated_windows(docs: DataFrame, length: int = 50, filter_bits: int = 27, shard_words: int = 1 << 16) -> DataFrame:
    """``docs(doc_id long, mark long, data binary)`` -> ``doc_id, mark, starts``: first words of windows that a smaller id has too."""
    if not GRAM < length <= MARGIN // 2:
        raise ValueError(f"windows have more than {GRAM} words and at most {MARGIN // 2}")
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    live = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("data") >= 2 * length - 1))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def give(part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"h": part["h"], "x": part["x"], "lows": first_holders(part, length)})

        held, size = [], 0
        for b in batches:
            if not len(b):
                continue
            words = b["size"].to_numpy()
            core = b["h"].to_numpy()
            begin = 0
            for end in [*(np.flatnonzero(core[1:] != core[:-1]) + 1).tolist(), len(b)]:
                # a core goes on in the next batch as part of the same shard
                if size >= shard_words and held and core[begin] != held[-1]["h"].iloc[-1]:
                    yield give(pd.concat(held))
                    held, size = [], 0
                held.append(b.iloc[begin:end])
                size += int(words[begin:end].sum())
                begin = end
        if held:
            yield give(pd.concat(held))

    found, tables, done = stored(_places(live, length, filter_bits), "places"), [], []
    while True:
        tables.append(found)
        # one row for equal stretches; cores of a single document are dropped
        rows = stored(found.groupBy("h", "x").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("words").alias("words"),
                                                  F.max(F.col("n") + length - 1).alias("size")), "stretches")
        cores = stored(rows.groupBy("h").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.sum("size").alias("total"),
                                             F.count("*").alias("of")).where("least < most")
                       .select("h", ((F.col("total") > shard_words) & (F.col("of") > 1)).alias("hot")), "shards")
        tables += [rows, cores]
        release(spark)
        usual = rows.drop("high").join(cores.where("not hot").select("h"), "h")
        lows = stored(usual.repartition(n, "h").sortWithinPartitions("h").mapInPandas(stream, "h long, x long, lows array<long>"), "lows")
        tables.append(lows)
        earlier = F.filter(F.sequence(F.lit(0), F.size("lows") - 1), lambda i: F.col("lows")[i] < F.col("doc_id"))
        done.append(found.select("h", "x", "doc_id", "mark", "lo").join(lows, ["h", "x"])
                    .select("doc_id", "mark", F.transform(earlier, lambda i: F.col("lo") + i).alias("starts")).where(F.size("starts") > 0))
        hot = cores.where("hot").select("h")
        if hot.isEmpty():
            break
        split = found.drop("words").join(rows.join(hot, "h").select("h", "x", "words"), ["h", "x"])
        found = stored(_halves(split, length), "places")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    # a document's starts are one list, bounded by its text
    out = stored(every.groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    discard(spark, tables)
    release(spark)
    return out


def cut_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, filter_bits: int = 27,
              shard_words: int = 1 << 16) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (first word and end of each removed run) and ``kept``, the other words joined by a space.

    Columns of these names are replaced.
    """
    data = as_bytes(text_col)
    mark = F.xxhash64(data)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), mark.alias("mark"), data.alias("data"))
    starts = repeated_windows(slim, length, filter_bits, shard_words) \
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("starts").alias("_starts"))

    @F.pandas_udf("n_words long, spans array<struct<start:long,stop:long>>, kept string")
    def cut(data: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for d, s in zip(data, starts):
            words, spans = d.split(), []
            if s is not None and len(s):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, s, 1)
                np.add.at(edge, np.asarray(s) + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                spans = [{"start": a, "stop": z} for a, z in zip(turn[::2].tolist(), turn[1::2].tolist())]
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                kept = words
            out.append((len(words), spans, b" ".join(kept).decode()))
        return pd.DataFrame(out, columns=["n_words", "spans", "kept"])

    joined = docs.join(starts, (F.col(id_col).cast("long") == F.col("_id")) & (mark == F.col("_mark")), "left")
    return joined.withColumn("_cut", cut(data, F.col("_starts"))).withColumns({c: F.col("_cut")[c] for c in ("n_words", "spans", "kept")}) \
        .drop("_id", "_mark", "_starts", "_cut")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, **bounds) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every document."""
    cut = cut_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), length=length, **bounds)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return cut.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
