"""Token counts by rank-synchronous merging of ragged symbol arrays.

A byte-level BPE vocabulary (the ``tokenizers`` JSON layout) is read once per
Python worker.  Texts come in Arrow batches and are cut into pre-tokens; the
batch's distinct pre-tokens not yet counted are held as one ragged array of
symbol ids.  In each round every sequence applies its own lowest-rank pair at
all its places at once (left to right where places overlap), until no
sequence has a pair left.  The surviving symbols of a pre-token are its count.
No pre-token reaches over a single space between two other characters, so
texts are first cut there, and each distinct cut is tokenised once: counts of
short cuts are kept between batches in a table of bounded size, which is
emptied when full and changes no result.

Null and empty texts have no tokens.  Special strings inside a text count as
one token each, as the library's default has it.  Repeated rows, null ids and
extra columns pass unchanged.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import as_bytes

# Fixed value: how byte-level BPE cuts a text into pre-tokens.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""

#: Cuts whose counts a worker keeps, and the longest kept one.
KEPT, KEPT_CHARS = 600_000, 40
#: Texts and characters whose pre-tokens are merged together.
GROUP, GROUP_CHARS = 4096, 1 << 23


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merger:
    """The merges of a vocabulary file, and counts by them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        vocab = spec["model"]["vocab"]
        self.base = np.array([vocab[s] for _, s in sorted(byte_symbols().items())], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(self.key)
        self.slots, self.probes = self._hashed()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.pattern = regex.compile(PRE_TOKEN)
        self.counts: dict[str, int] = {}

    def _hashed(self, bits: int = 18) -> tuple[np.ndarray, int]:
        """Open addressing: ranks by hashed pair, and the longest probe."""
        slots, todo, probe = np.full(1 << bits, -1, np.int32), np.arange(self.none), 0
        while len(todo):
            at = (self._slot(self.key[todo], bits) + probe) & ((1 << bits) - 1)
            free = slots[at] < 0
            slots[at[free]] = todo[free]
            todo = todo[slots[at] != todo]
            probe += 1
        return slots, probe

    @staticmethod
    def _slot(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` for pairs that have no merge."""
        want = left * self.width + right
        mask = len(self.slots) - 1
        at = self._slot(want, mask.bit_length())
        out = np.full(len(want), self.none, np.int64)
        todo = np.arange(len(want))
        for _ in range(self.probes):
            found = self.slots[at]
            hit = (found >= 0) & (self.key[found] == want)
            out[todo[hit]] = found[hit]
            on = (found >= 0) & ~hit
            if not on.any():
                break
            todo, at, want = todo[on], (at[on] + 1) & mask, want[on]
        return out

    def survivors(self, pieces: list[str]) -> np.ndarray:
        """Symbols left of each piece."""
        data = [p.encode("utf-8") for p in pieces]
        size = np.fromiter(map(len, data), np.int64, len(data))
        out = size.copy()
        sym = self.base[np.frombuffer(b"".join(data), np.uint8)]
        seq = np.repeat(np.arange(len(data)), size)
        rank = None
        while len(sym) > 1:
            if rank is None:
                rank = np.where(seq[:-1] == seq[1:], self._ranks(sym[:-1], sym[1:]), self.none)
            # sequences are contiguous: the lowest rank of each
            first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            low = np.minimum.reduceat(np.append(rank, self.none), first)
            live = low < self.none
            if not live.any():
                break
            if not live.all():  # ended sequences leave the arrays
                length = np.diff(np.append(first, len(sym)))
                keep = np.repeat(live, length)
                out[seq[first[~live]]] = length[~live]
                both = keep[:-1] & keep[1:]
                # a pair across a removed stretch can't match: its sequences differ
                rank = rank[both]
                sym, seq = sym[keep], seq[keep]
                if len(rank) != len(sym) - 1:
                    rank = None
                    continue
                first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
                low = low[live]
            length = np.diff(np.append(first, len(sym)))
            at = np.flatnonzero(rank == np.repeat(low, length)[:-1])
            at = at[rank[at] < self.none]
            # of places that overlap in a run (aaa), every second one from the left
            if len(at) > 1:
                begins = np.concatenate(([True], np.diff(at) != 1))
                start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            sym = sym.copy()
            sym[at] = self.new[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
            # ranks change only beside a merged symbol
            rank = rank[keep[1:]]
            if len(sym) > 1:
                moved = at - np.arange(len(at))
                for side in (moved, moved - 1):
                    side = side[(side >= 0) & (side < len(sym) - 1)]
                    rank[side] = np.where(seq[side] == seq[side + 1], self._ranks(sym[side], sym[side + 1]), self.none)
        left = np.bincount(seq, minlength=len(out))
        return np.where(left > 0, left, out)

    def _pieces(self, cuts: list[str]) -> list[int]:
        """Tokens of each string, by its pre-tokens."""
        plain = [self.pattern.findall(c) for c in cuts]
        new = list(set().union(*plain))
        of = {}
        for i in range(0, len(new), 1 << 16):
            part = new[i:i + (1 << 16)]
            of.update(zip(part, self.survivors(part).tolist()))
        return [sum(map(of.__getitem__, p)) for p in plain]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        runs, found = [], []  # runs: (text number, text without special strings)
        for i, t in enumerate(texts):
            cut = self.special.split(t) if self.special and self.special.search(t) else [t]
            found.append(len(cut) - 1)
            runs += [(i, c) for c in cut if c]
        cuts = [f" {c}".split(" ")[1:] for _, c in runs]
        whole = set()  # runs with other white space beside a space, or at an end: not cut
        need = set().union(*(c[1:] for c in cuts))
        new = [c for c in need if c not in self.counts]
        if len(self.counts) + len(new) > KEPT:
            self.counts.clear()
            new = list(need)
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        new = [c for c in new if c not in odd]
        look = dict(zip(new, self._pieces([f" {c}" for c in new])))
        self.counts.update(x for x in look.items() if len(x[0]) <= KEPT_CHARS)
        if any(len(c) > KEPT_CHARS for c in new):
            look = {c: look[c] if c in look else self.counts[c] for c in need if c not in odd}
        else:
            look = self.counts
        for j, c in enumerate(cuts):
            if c[0] == "" or c[0][-1:].isspace() or odd and not odd.isdisjoint(c[1:]):
                whole.add(j)
        firsts = self._pieces([r[1] if j in whole else c[0] for j, (r, c) in enumerate(zip(runs, cuts))])
        for j, ((i, _), c, n) in enumerate(zip(runs, cuts, firsts)):
            found[i] += n if j in whole else n + sum(map(look.__getitem__, c[1:]))
        return found


@lru_cache(maxsize=4)
def merger(path: str) -> Merger:
    return Merger(path)


def groups(texts: list[str]):
    """Runs of texts, bounded in number and characters."""
    run, chars = [], 0
    for t in texts:
        if run and (len(run) >= GROUP or chars + len(t) > GROUP_CHARS):
            yield run
            run, chars = [], 0
        run.append(t)
        chars += len(t)
    if run:
        yield run


def token_counts(docs: DataFrame, vocab_path: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (columns of these names are replaced).

    ``vocab_path`` must name the same vocabulary file on every executor.
    """
    @F.pandas_udf("long")
    def tokens(text: pd.Series) -> pd.Series:
        m = merger(vocab_path)
        return pd.Series([n for g in groups(text.tolist()) for n in m.count(g)], dtype="int64")

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(as_bytes(text_col)).cast("long"), "n_tokens": tokens(text)}) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
