"""Rolling hashes, content-chosen samples and bit tables, over sequences of bytes or of word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Symbols hashed at once, so that very long texts take bounded memory, and the longest stretch.
CHUNK, MARGIN = 1 << 20, 4096
#: Words of more bytes are hashed on their own.
LONG = 256


def byte_set(own: bytes) -> np.ndarray:
    """Whether each byte is one of ``own``."""
    out = np.zeros(256, bool)
    out[list(own)] = True
    return out


_SPACE = byte_set(b" \t\n\x0b\x0c\r")


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


UP, DOWN = _powers(BASE, CHUNK + MARGIN), _powers(INVERSE, CHUNK + MARGIN)


def sums(b: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows (of at most ``CHUNK + MARGIN`` symbols)."""
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * UP[:len(b)], dtype=np.uint64, out=total[1:])
    return total


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of ``h`` well mixed, in place."""
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def stretch(total: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of ``size`` symbols from each start."""
    return mixed((total[start + size] - total[start]) * DOWN[start])


def spans(symbols: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of at most ``MARGIN`` symbols of a sequence of any length; starts ascend."""
    out = np.zeros(len(start), np.uint64)
    cut = np.searchsorted(start, np.arange(0, len(symbols) + CHUNK, CHUNK))
    for i, (a, z) in enumerate(zip(cut[:-1], cut[1:])):
        if z > a:
            base = i * CHUNK
            total = sums(symbols[base:base + CHUNK + MARGIN])
            out[a:z] = mixed((total[stop[a:z] - base] - total[start[a:z] - base]) * DOWN[start[a:z] - base])
    return out


class Words:
    """The words of several texts, end to end: where they lie in ``flat``, their hashes, and each text's first word.

    ``space``: the bytes that separate words, a line feed among them; ``names``: 256 bytes that the hashes see in place of the texts'.
    """

    def __init__(self, texts: list[bytes], space: np.ndarray = _SPACE, names: bytes | None = None):
        self.flat = b"\n".join(texts)
        b = np.frombuffer(self.flat, np.uint8)
        edge = np.diff(np.concatenate(([True], space[b], [True])).astype(np.int8))
        self.start, self.stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.start, offset)
        long = self.stop - self.start > LONG
        seen = self.flat if names is None else self.flat.translate(names)
        self.hashes = spans(np.frombuffer(seen, np.uint8), self.start, np.where(long, self.start, self.stop))
        for i in np.flatnonzero(long):
            self.hashes[i] = xxhash.xxh3_64_intdigest(seen[self.start[i]:self.stop[i]])

    def joined(self, a: int, z: int) -> bytes:
        """Words ``a`` to ``z`` - 1, a space between them."""
        return b" ".join(self.flat[self.start[a]:self.stop[z - 1]].split())


def grouped(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def slid(x: np.ndarray, w: int, better) -> np.ndarray:
    """``better`` (minimum or maximum) over every ``w`` neighbours."""
    n = len(x)
    pad = -n % w
    worst = np.uint64(0xFFFFFFFFFFFFFFFF) if better is np.minimum else np.uint64(0)
    y = np.concatenate((x, np.full(pad, worst, np.uint64))).reshape(-1, w)
    ahead = better.accumulate(y, axis=1).reshape(-1)
    back = better.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return better(back[:n - w + 1], ahead[w - 1:n])


def _sampled(b: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    w = length - gram + 1
    total = sums(b)
    h = mixed((total[gram:] - total[:-gram]) * DOWN[:len(b) - gram + 1])
    low = slid(h, w, np.minimum)  # of each window
    edge = np.zeros(w - 1, np.uint64)
    chosen = slid(np.concatenate((edge, low, edge)), w, np.maximum) == h
    at = np.flatnonzero(chosen)
    # the first chosen place from the window's start on that has its smallest hash
    spot = (np.cumsum(chosen) - chosen)[:len(low)]
    todo = np.flatnonzero(h[at[spot]] != low)
    while len(todo):
        spot[todo] += 1
        todo = todo[h[at[spot[todo]]] != low[todo]]
    lo = np.flatnonzero(np.concatenate(([True], spot[1:] != spot[:-1])))
    hi = np.append(lo[1:], len(low)) - 1
    p = at[spot[lo]]
    # a window holds the gram and half of its other symbols before it, or the gram and half of them after it
    half = (length - gram) // 2
    some = p - lo >= half
    left = np.zeros(len(p), np.uint64)
    left[some] = stretch(total, p[some] - half, gram + half) ^ np.uint64(1 << 20)
    some = p - hi <= length - gram - half
    right = np.zeros(len(p), np.uint64)
    right[some] = stretch(total, p[some], gram + half)
    return p, lo, hi, h[p], left, right


def sampled(b: np.ndarray, length: int, gram: int, chunk: int = CHUNK) -> tuple[np.ndarray, ...]:
    """Sampled places, first and last window start of each, gram hashes, hashes of the longer stretches before and after.

    In every window of ``length`` symbols the ``gram`` of smallest hash is sampled (the leftmost of equals), so equal
    windows choose alike.  A stretch that no window of the place holds has hash 0.  A place can come twice where a chunk
    ends, each time with its own windows.
    """
    n = len(b)
    if n < length:
        empty = np.array([], np.int64)
        none = np.array([], np.uint64)
        return empty, empty, empty, none, none, none
    parts = []
    for start in range(0, n - length + 1, chunk):
        p, lo, hi, *h = _sampled(b[start:start + chunk + length - 1], length, gram)
        parts.append((p + start, lo + start, hi + start, *h))
    return tuple(np.concatenate(x) for x in zip(*parts))


def bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value of the first ``bits`` bits of column ``h``: a table of ``2 ** bits / 8`` bytes, whatever the rows."""
    page_bits = min(bits, 15)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages: dict[int, np.ndarray] = {}
        for b in batches:
            at = b["at"].to_numpy()
            for page in np.unique(at >> page_bits):
                low = at[at >> page_bits == page] & ((1 << page_bits) - 1)
                pages.setdefault(int(page), np.zeros(1 << page_bits, bool))[low] = True
        yield pd.DataFrame({"page": list(pages), "bits": [np.packbits(x).tobytes() for x in pages.values()]})

    n = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.select(at.alias("at")).repartition(n, F.shiftright("at", page_bits)).mapInPandas(run, "page long, bits binary").collect()
    table = np.zeros((1 << (bits - page_bits), 1 << page_bits >> 3), np.uint8)
    for r in rows:
        table[r.page] = np.frombuffer(r.bits, np.uint8)
    return table.reshape(-1)


def in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in the table."""
    bits = (len(table) * 8).bit_length() - 1
    at = h >> np.uint64(64 - bits)
    return table[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def met_twice(docs: DataFrame, hashes_of: Callable[[list[bytes]], Iterator[tuple[np.ndarray, np.ndarray]]], buckets: int = 16) -> DataFrame:
    """Column ``h``: hashes (their first 48 bits) that two or more texts of ``docs(data)`` have.

    ``hashes_of`` gives hashes and the numbers of their texts in ascending blocks of a batch's texts; 0 is none.  Hashes
    travel as sorted lists of 6 bytes each, by ranges of values: ``buckets`` for each shuffle partition.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(parts * buckets, 1 << 16)

    def give(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            value = np.repeat(value, np.minimum(count, 2))  # of several texts of the task: twice is enough
            bucket = ((value >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(16)).astype(np.int64)
            low = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
            return pd.DataFrame({"bucket": bucket[cut], "hashes": [low[a:z].tobytes() for a, z in zip(cut, [*cut[1:], len(bucket)])]})

        for b in batches:
            for h, text in hashes_of(b["data"].tolist()):
                h, text = h[h != 0] >> np.uint64(16), text[h != 0]
                order = np.lexsort((text, h))
                h, text = h[order], text[order]
                held.append(h[np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))] if len(h) else h)
                size += len(held[-1])
                if size > 1 << 20:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(blocks):
            raw = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, 6)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :6] = raw
            value = np.sort(wide.view("<u8").reshape(-1))
            return pd.DataFrame({"h": (np.unique(value[1:][value[1:] == value[:-1]]) << np.uint64(16)).view(np.int64)})

        at, blocks = None, []
        for b in batches:
            for bucket, hashes in zip(b["bucket"], b["hashes"]):
                if bucket != at and blocks:
                    yield out(blocks)
                    blocks = []
                at = bucket
                blocks.append(hashes)
        if blocks:
            yield out(blocks)

    return docs.select("data").mapInPandas(give, "bucket int, hashes binary").repartition(parts, "bucket").sortWithinPartitions("bucket") \
        .mapInPandas(count, "h long")
