"""Toxicity scores from a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits and signs that stand for
letters, invisible characters) and matched by an Aho-Corasick automaton
against lexicon words, word beginnings and exception phrases.  A hit inside
an exception phrase does not count.  The weights of the hits, and the same
normalised by the text's length, give the score.

The lexicon is learned from labelled rows that are not held out
(crc32 of the id as text, modulo 3, is 1): at most ``per_class`` rows of each
label, those whose hashed id is smallest.  Document counts of all their words
and word beginnings are summed in Spark, one row (that of the smallest id) for
texts of a label that are alike in full when folded (copies would make any of
their words look toxic).  Terms far more frequent in toxic rows are candidates.  Those in
``share`` of the toxic rows are taken, and of the rest those that a greedy
cover needs.  A two-weight logistic curve maps hits to 0..1.  The bounds
are ``per_class``, ``candidates`` and ``lexicon``: they limit the model's
size, never the rows scored.

Null texts count as empty and get the curve's value for no hit.  Rows without
an id are scored and never learned from.  Labels that are null are ignored,
of contradicting labels of an id the higher holds; without both labels the
lexicon is empty and every score 0.  Repeated rows and extra columns pass
unchanged; columns named as the results are replaced.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import remainder, stored

# Digits and signs written for letters, and letters of other scripts that look like Latin ones.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a"}
LOOKALIKES = dict(zip("аеёорсухіїјѕӏԁһкмтвнαοερτυιικνχηωγβµ", "aeeopcyxiijslhhkmtbhaoeptuiikvxnwybu"))
LOOKALIKES["ԁ"] = "d"
BEGINNINGS = (4, 5, 6, 7, 8)


def _folded_char(c: str) -> str | None:
    if c in DIGITS:
        return DIGITS[c]
    if c != "­" and unicodedata.category(c) in ("Cf", "Mn") or c == "­":
        return ""
    base = "".join(x for x in unicodedata.normalize("NFKD", c).lower() if unicodedata.category(x) != "Mn")
    base = "".join(LOOKALIKES.get(x, DIGITS.get(x, x)) for x in base)
    return base if base and base.isalpha() else " "


#: Blocks with letters, marks and signs that need folding; other characters stay.
_BLOCKS = [(0, 0x530), (0x1E00, 0x2070), (0x2100, 0x2150), (0xFE00, 0xFE10), (0xFEFF, 0xFF5F)]
FOLD = {cp: _folded_char(chr(cp)) for a, b in _BLOCKS for cp in range(a, b)}
_DOLLAR = re.compile(r"\$(?=\w)")


def fold(text: str | None) -> str:
    """Folded words, each between single spaces; a space before the first and after the last."""
    if not text:
        return " "
    if "$" in text:
        text = _DOLLAR.sub("s", text)
    words = text.translate(FOLD).split()
    return f" {' '.join(words)} " if words else " "


def terms(folded: str) -> set[str]:
    """Words (with a space after) and word beginnings (without), each after a space."""
    words = set(folded.split())
    out = {f" {w} " for w in words if len(w) > 2}
    for n in BEGINNINGS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def signature(text: str | None) -> int:
    """Hash of a text's folded words, all in order."""
    return int.from_bytes(hashlib.blake2b(fold(text).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@dataclass
class Model:
    """Lexicon weights, exception phrases and the logistic curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_machine"}

    def machine(self):
        if "_machine" not in self.__dict__:
            m = ahocorasick.Automaton()
            for t, w in self.weights.items():
                m.add_word(t, (len(t), w))
            for p in self.exceptions:
                m.add_word(p, (len(p), None))
            if len(m):
                m.make_automaton()
            self._machine = m
        return self._machine

    def hits(self, folded: str) -> dict[int, float]:
        """Weight by start of each hit outside exception phrases: the highest of a word."""
        m = self.machine()
        found: dict[int, float] = {}
        if not len(m):
            return found
        spans = []
        for end, (size, weight) in m.iter(folded):
            at = end - size + 1
            if weight is None:
                spans.append((at, end))
            elif weight > found.get(at, 0.0):
                found[at] = weight
        for a, b in spans:
            for at in [x for x in found if a <= x <= b - 1]:
                del found[at]
        return found

    def measures(self, text: str | None) -> tuple[float, float]:
        """Summed weight, and summed weight for a hundred words of length."""
        folded = fold(text)
        total = sum(self.hits(folded).values())
        return total, total * 100 / max(1, folded.count(" ") - 1)

    def scores(self, measured: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(measured))
        a, b, c = self.curve
        z = a + b * np.log1p(measured[:, 0]) + c * np.log1p(measured[:, 1])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Newton steps on the ridge-penalised logistic loss."""
    f = np.column_stack([np.ones(len(x)), np.log1p(x)])
    w, pen = np.zeros(3), np.diag([1e-6, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -40, 40)))
        step = np.linalg.solve((f * (p * (1 - p))[:, None]).T @ f + pen, f.T @ (y - p) - pen @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _cover(rows: list[list[str]], weights: dict[str, float], most: int, gain: int) -> list[str]:
    """Greedy cover of toxic rows by their candidate terms; longer terms win ties."""
    left = [set(r) for r in rows if r]
    count = Counter(t for r in left for t in r)
    of: dict[str, list[int]] = {}
    for i, r in enumerate(left):
        for t in r:
            of.setdefault(t, []).append(i)
    open_, out = [True] * len(left), []
    while len(out) < most and count:
        best = max(count, key=lambda t: (count[t], weights[t], len(t), t))
        if count[best] < gain:
            break
        out.append(best)
        for i in of[best]:
            if open_[i]:
                open_[i] = False
                count.subtract(left[i])
        del count[best]
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = 10_000,
          candidates: int = 4096, lexicon: int = 1024, least: int = 3, odds: float = 3.0, gain: int = 3,
          share: float = 0.02, exceptions: tuple[str, ...] = (), fold_size: int = 3, held: int = 1) -> Model:
    """A model from the labelled rows that are not held out (see the module's text)."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")) \
        .where(remainder("doc_id", fold_size) != held)
    picked = None
    for label in (0, 1):
        part = y.where(F.col("y") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    @F.pandas_udf("long")
    def sig(text: pd.Series) -> pd.Series:
        return pd.Series([signature(t) for t in text], dtype="int64")

    sample = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                    .join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y", sig("text").alias("sig")), "toxic-sample")
    once = stored(sample.groupBy("sig", "y").agg(F.min(F.struct("doc_id", "text")).alias("first")).select("first.text", "y"), "toxic-once")
    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model = Model(exceptions=[f" {' '.join(fold(e).split())} " for e in exceptions])
    if not n.get(0) or not n.get(1):
        return model

    n_once = {r.y: r.n for r in once.groupBy("y").agg(F.count("*").alias("n")).collect()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()

        def out():
            keys = list(toxic.keys() | clean.keys())
            frame = pd.DataFrame({"term": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})
            toxic.clear(), clean.clear()
            return frame

        for b in batches:
            for t, label in zip(b["text"], b["y"]):
                (toxic if label else clean).update(terms(fold(t)))
                if len(toxic) + len(clean) > 500_000:
                    yield out()
        yield out()

    odd = F.log((F.col("toxic") + 0.5) / (n_once[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (n_once[0] + 1.0))
    found = once.mapInPandas(count, "term string, toxic long, clean long").groupBy("term") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least) \
        .withColumn("weight", odd).where(F.col("weight") >= odds) \
        .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "term").limit(candidates).collect()
    weights = {r.term: float(r.weight) for r in found}

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"found": [[x for x in terms(fold(t)) if x in weights] for t in b["text"]]})

    # at most per_class rows of at most ``candidates`` terms
    rows = [sorted(r.found) for r in sample.where("y = 1").mapInPandas(inside, "found array<string>").collect()]
    strong = {r.term: r.toxic for r in found if r.toxic >= max(least, share * n_once[1]) and r.weight >= odds + 2}
    # of a word and its beginnings in the same rows, the longest says it best
    strong = [t for t in strong if not any(u != t and u.startswith(t) and strong[u] >= 0.98 * strong[t] for u in strong)][:lexicon]
    model.weights = {t: weights[t] for t in [*strong, *_cover([[] if set(r) & set(strong) else r for r in rows], weights, lexicon, gain)]}
    model.exceptions += _learned_exceptions(sample, model, least)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = [model.measures(t) for t in b["text"]]
            yield pd.DataFrame({"total": [x[0] for x in m], "rate": [x[1] for x in m], "y": b["y"]})

    # at most 2 * per_class rows of three numbers
    x = sample.mapInPandas(measure, "total double, rate double, y int").toPandas().sort_values(["y", "total", "rate"])
    model.curve = _logistic(x[["total", "rate"]].to_numpy(), x["y"].to_numpy(float))
    return model


def _learned_exceptions(sample: DataFrame, model: Model, least: int, most: int = 1000) -> list[str]:
    """Two-word phrases around lexicon hits that only rows labelled clean hold, at least ``least`` of them."""
    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for t, label in zip(b["text"], b["y"]):
                folded = fold(t)
                own = set()
                for at in model.hits(folded):
                    before = folded.rfind(" ", 0, at)
                    end = folded.find(" ", at + 1)
                    after = folded.find(" ", end + 1)
                    if at > 0:
                        own.add(folded[before:end + 1])
                    if after > 0:
                        own.add(folded[at:after + 1])
                got += [(p, int(label), 1 - int(label)) for p in own]
            yield pd.DataFrame(got, columns=["phrase", "toxic", "clean"])

    return [r.phrase for r in sample.mapInPandas(phrases, "phrase string, toxic long, clean long").groupBy("phrase")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where((F.col("toxic") == 0) & (F.col("clean") >= least))
            .orderBy(F.desc("clean"), "phrase").limit(most).collect()]


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
           fold_size: int = 3, held: int = 1) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([model.measures(t) for t in text], float).reshape(-1, 2)))

    return docs.withColumns({"held_out": remainder(id_col, fold_size) == held, "score": score(F.col(text_col).cast("string"))}) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
