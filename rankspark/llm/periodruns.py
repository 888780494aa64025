"""Periodic runs of words by block convolution.

A run is a stretch of a text's words with smallest period q (words q apart are
identical) and at least ``times`` * q and ``least`` words, that no neighbour
extends keeping period q.

* Scales.  A run with period q in [B, 2 B), B a power of two, holds a block of
  B words that starts at a multiple of B, and its next occurrence q words
  later.  So each block of each scale B is looked for in the window of 2 B
  words that follows it.
* Convolution.  A block's words are numbered from 1, words of the window that
  the block lacks are 0.  The sum of squared differences at every distance is
  the block's squares plus the window's squares under it less twice their
  correlation.  That is computed modulo primes by a number-theoretic transform
  of 2 B numbers, for many blocks at once.  The sum is below B ** 3; as many
  primes are taken as have a larger product, so it is zero if and only if it
  is zero modulo each of them: a distance without a mismatch.
* Extension.  Such a distance d is a seed: words d apart are compared to both
  sides of the block up to the first mismatch.  Of seeds that lead to the
  same stretch the smallest distance is its period.

Left out without loss: blocks with a word that doesn't come again within 2 B
words, blocks that lie with their window in a run known from a smaller scale
whose period goes twice into B, and seeds that such a run explains.

Texts are handled where they lie, in groups of bounded size; nothing is
shuffled.  Words are compared unchanged, runs never cross texts.

Null and empty texts have no words and no runs.  Repeated rows and null ids
are rows like any other; extra columns pass unchanged; columns ``n_words``,
``runs`` and ``collapsed`` are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import as_bytes

#: Primes c * 2**k + 1 and a primitive root of each; transforms of up to 2**25 numbers.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Numbers transformed at once.
STEP = 1 << 18
NEVER = np.int64(1 << 60)


@lru_cache(maxsize=256)
def _roots(prime: int, root: int, size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``, half of them."""
    g = pow(root, (prime - 1) // size, prime)
    if inverse:
        g = pow(g, -1, prime)
    out = np.ones(max(1, size // 2), np.uint64)
    done = 1
    while done < len(out):  # by doubling
        out[done:2 * done] = out[:done] * np.uint64(pow(g, done, prime)) % np.uint64(prime)
        done *= 2
    return out


def transform(a: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    m, size = a.shape
    p = np.uint64(prime)
    half = size // 2
    while half:
        a = a.reshape(m, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1]
        total, less = u + v, u + (p - v)
        a = np.stack((np.minimum(total, total - p), less * _roots(prime, root, 2 * half, False) % p), axis=2)
        half //= 2
    return a.reshape(m, size)


def inverse(a: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Rows back from ``transform``."""
    m, size = a.shape
    p = np.uint64(prime)
    half = 1
    while half < size:
        a = a.reshape(m, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1] * _roots(prime, root, 2 * half, True) % p
        total, less = u + v, u + (p - v)
        a = np.stack((np.minimum(total, total - p), np.minimum(less, less - p)), axis=2)
        half *= 2
    return a.reshape(m, size) * np.uint64(pow(size, -1, prime)) % p


def matches(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Where each row's ``block`` (B numbers, 1 to B) occurs in its ``window`` (2 B numbers, 0 to B): rows of B offsets."""
    m, b = block.shape
    out = np.ones((m, b), bool)
    bound = b ** 3
    for prime, root in PRIMES:
        p = np.uint64(prime)
        x = np.zeros((m, 2 * b), np.uint64)
        x[:, 0], x[:, b + 1:] = block[:, 0], block[:, :0:-1]  # backwards: the convolution is a correlation
        y = window.astype(np.uint64)
        cross = inverse(transform(x, prime, root) * transform(y, prime, root) % p, prime, root)[:, :b]
        squares = np.concatenate((np.zeros((m, 1), np.uint64), np.cumsum(y * y % p, axis=1)), axis=1)
        under = (squares[:, b:2 * b] - squares[:, :b]) % p
        own = (block.astype(np.uint64) ** np.uint64(2) % p).sum(axis=1, dtype=np.uint64)[:, None] % p
        out &= (own + under) % p == cross * np.uint64(2) % p
        bound //= prime
        if not bound:
            return out
    raise ValueError("text too long: its blocks need more primes")


def _numbered(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks from each start and the windows after them, with the words of each block numbered from 1."""
    block = ids[start[:, None] + np.arange(b)]
    at = start[:, None] + b + np.arange(2 * b)
    window = np.where(at < stop[:, None], ids[np.minimum(at, len(ids) - 1)], -1)
    row = np.arange(len(start))[:, None] * (int(ids.max()) + 2)
    own = np.unique(block + row)
    first = np.searchsorted(own, row[:, 0])[:, None]
    spot = np.searchsorted(own, window + row)
    inside = (window >= 0) & (own[np.minimum(spot, len(own) - 1)] == window + row)
    return np.searchsorted(own, block + row) - first + 1, np.where(inside, spot - first + 1, 0)


def _seeds(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (block start, distance from ``b`` to 2 ``b`` - 1 at which the block comes again)."""
    starts, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, STEP // (2 * b))
    for i in range(0, len(start), step):
        row, offset = np.nonzero(matches(*_numbered(ids, start[i:i + step], stop[i:i + step], b)))
        starts.append(start[i:i + step][row])
        distances.append(offset + b)
    return np.concatenate(starts), np.concatenate(distances)


def _reach(ids: np.ndarray, at: int, d: int, end: int, step: int) -> int:
    """The first place from ``at`` on (backwards for ``step`` -1) whose word differs from that ``d`` words later, or ``end``."""
    size = 64
    while at != end:
        n = min(size, abs(end - at))
        own = ids[at:at + n] != ids[at + d:at + d + n] if step > 0 else (ids[at - n + 1:at + 1] != ids[at - n + 1 + d:at + 1 + d])[::-1]
        off = int(own.argmax())
        if own[off]:
            return at + step * off
        at += step * n
        size *= 2
    return end


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts that lie end to end, in word numbers of the whole, sorted."""
    if times < 3:
        raise ValueError("runs are at least three periods long")
    edges = np.concatenate(([0], np.cumsum(sizes)))
    begin, stop = np.repeat(edges[:-1], sizes), np.repeat(edges[1:], sizes)
    order = np.argsort(ids, kind="stable")
    far = np.full(len(ids), NEVER)  # the largest distance in a block from a word to the next equal one
    same = (ids[order[1:]] == ids[order[:-1]]) & (begin[order[1:]] == begin[order[:-1]])
    far[order[:-1][same]] = (order[1:] - order[:-1])[same]
    known = np.zeros((0, 3), np.int64)
    place = np.arange(len(ids))
    b = 1
    while b * times <= sizes.max(initial=0):
        block = np.flatnonzero(((place - begin) % b == 0) & (far < 2 * b) & (place + 2 * b <= stop) & (stop - begin >= times * b))
        short = known[known[:, 2] * 2 <= b]  # runs that explain all distances within them
        if len(short) and len(block):
            edge = np.zeros(len(block) + 1, np.int64)
            lo, hi = np.searchsorted(block, short[:, 0]), np.searchsorted(block, short[:, 0] + short[:, 1] - 3 * b, "right")
            some = hi > lo
            np.add.at(edge, lo[some], 1)
            np.add.at(edge, hi[some], -1)
            block = block[np.cumsum(edge[:-1]) == 0]
        start, d = _seeds(ids, block, stop[block], b)
        if len(short) and len(start):
            fresh = np.ones(len(start), bool)
            lo, hi = np.searchsorted(start, short[:, 0]), np.searchsorted(start, short[:, 0] + short[:, 1] - 2 * b, "right")
            for r in np.flatnonzero(hi > lo):
                s = slice(lo[r], hi[r])
                fresh[s] &= (d[s] % short[r, 2] != 0) | (start[s] + b + d[s] > short[r, 0] + short[r, 1])
            start, d = start[fresh], d[fresh]
        order = np.lexsort((start, d))
        start, d = start[order], d[order]
        new, i = [], 0
        while i < len(start):
            at, q = int(start[i]), int(d[i])
            right = _reach(ids, at + b, q, int(stop[at]) - q, 1)
            left = _reach(ids, at - 1, q, int(begin[at]) - 1, -1) + 1
            if right - left + q >= max(least, times * q):
                new.append((left, right - left + q, q))
            # other seeds of this distance up to there lead to the same stretch
            i += int(np.searchsorted(start[i:i + int(np.searchsorted(d[i:], q, "right"))], right - b, "right")) or 1
        if new:
            known = np.concatenate((known, np.array(new, np.int64)))
            known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
            known = known[np.concatenate(([True], (known[1:, :2] != known[:-1, :2]).any(axis=1)))]
        far[:-b] = np.maximum(far[:-b], far[b:])
        b *= 2
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _grouped(texts: list[bytes], most: int = 256, words: int = 1 << 18) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for t in texts:
        held.append(t.split())
        size += len(held[-1])
        if len(held) >= most or size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held


def runs_of(texts: list[bytes], least: int = 6, times: int = 4) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Of each text the number of words, its runs, and its words without the repeats of runs."""
    for group in _grouped(texts):
        sizes = np.array([len(x) for x in group], np.int64)
        flat = [w for x in group for w in x]
        number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        found = find_runs(ids, sizes, least, times) if len(ids) else np.zeros((0, 3), np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        cut = np.searchsorted(found[:, 0], edges)
        for i, words in enumerate(group):
            own = found[cut[i]:cut[i + 1]] - [edges[i], 0, 0]
            if len(own):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, own[:, 0] + own[:, 2], 1)
                np.add.at(edge, own[:, 0] + own[:, 1], -1)
                words = [w for w, gone in zip(words, (np.cumsum(edge[:-1]) > 0).tolist()) if not gone]
            yield int(sizes[i]), own, b" ".join(words)


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period of each, by start and period) and ``collapsed``,

    the words that no run holds after its first period, joined by a space.
    """
    @F.pandas_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def find(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(n, [dict(zip(("start", "length", "period"), r)) for r in own.tolist()], kept.decode())
                             for n, own, kept in runs_of(text.tolist(), least, times)], columns=["n_words", "runs", "collapsed"])

    return docs.withColumn("_runs", find(as_bytes(text_col))) \
        .withColumns({c: F.col("_runs")[c] for c in ("n_words", "runs", "collapsed")}).drop("_runs")


def longest_run(runs: str = "runs"):
    """The run of greatest length of an array of runs, ties to the smallest start, then period; null without a run."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
