"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned from a bounded sample of labelled rows: words, and word beginnings of 4 to 6 letters, that stand in
many more toxic texts than others. Features of the sample's rows come from lexicons learned without their fold, so the
trees see densities as on new texts.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, give_back, mapped, slices, text_or_empty, texts

TOKEN = re.compile(r"[^\W\d_]+")
#: Letters with digits or signs inside, as in sh1t or f*ck.
MASKED = re.compile(r"\b[^\W\d_]+[@$!*0-9]+[^\W\d_]+")
#: What all of those have inside.
MASKING = re.compile(r"(?<=[^\W\d_])[@$!*0-9]+(?=[^\W\d_])")
STRETCHED = re.compile(r"([^\W\d_])\1\1+")
# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
FOLDS = 4
BEGINNINGS = (4, 5, 6)
NEAR = 5
FEATURES = ("hits", "density", "weight", "heaviest", "near_you", "you_rate", "shouted", "capitals", "exclaims", "punctuation", "signs", "masked", "masked_hits", "stretched", "digits", "words")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


class Weights(dict):
    """Weight of each word by the lexicon, remembered; forgotten when there are too many."""

    def __init__(self, words: dict[str, float], starts: dict[str, float], most: int = 100_000):
        super().__init__()
        self.words, self.starts, self.most = words, starts, most
        self.heads = {s[: BEGINNINGS[0]] for s in starts}

    def __missing__(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        if word[: BEGINNINGS[0]] in self.heads:
            w = max([w, *(self.starts.get(word[:n], 0.0) for n in BEGINNINGS if len(word) >= n)])
        if len(self) >= self.most:
            self.clear()
        self[word] = w
        return w


MASKS = str.maketrans("0134578@$!*", "oieastbasi.")


def stretched(text: str) -> int:
    """Runs of three or more equal letters. Few texts have any, which a comparison of neighbours tells."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    same = a[1:] == a[:-1]
    return len(STRETCHED.findall(text)) if (same[1:] & same[:-1]).any() else 0


def features(text: str, weights: Weights) -> list[float]:
    """The dense features of a whole text, in the order of FEATURES."""
    words = TOKEN.findall(text)
    n, chars = len(words) or 1, len(text) or 1
    # lowering may change what a word is only where it changes the length, as for a dotted capital I
    low = text.lower()
    lower = list(map(str.lower, words)) if len(low) == len(text) else TOKEN.findall(low)
    score = list(map(weights.__getitem__, lower))
    hits = [i for i, w in enumerate(score) if w]
    you = [i for i, w in enumerate(lower) if w in SECOND_PERSON]
    at = set(you)
    near = sum(any(j in at for j in range(i - NEAR, i + NEAR + 1)) for i in hits) if at else 0
    masked = MASKED.findall(text) if MASKING.search(text) else []
    letters = sum(map(len, words))
    raised = [w for w, v in zip(words, lower, strict=True) if w != v] if len(words) == len(lower) else words
    shouted = sum(map(str.isupper, raised))
    signs = chars - letters - text.count(" ") - text.count("\n")
    return [
        float(len(hits)), len(hits) / n, sum(score), max(score, default=0.0), float(near), len(you) / n, shouted / n, sum([w[0].isupper() for w in raised]) / n,
        text.count("!") / chars, sum(map(text.count, ".,;:?")) / chars, signs / chars, len(masked) / n, float(sum(weights[m.lower().translate(MASKS)] > 0 for m in masked)),
        stretched(text) / n, sum(map(text.count, "0123456789")) / chars, math.log1p(len(words)),
    ]


@dataclass
class Trees:
    """Boosted trees on logistic loss; each is arrays of split feature, cut, left child and leaf value."""

    base: float = 0.0
    trees: list = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cutoff, child, value in self.trees:
            at = np.zeros(len(x), np.int32)
            while (inner := feature[at] >= 0).any():
                right = x[np.arange(len(x)), np.maximum(feature[at], 0)] > cutoff[at]
                at = np.where(inner, child[at] + right, at)
            out += value[at]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, least: float = 2.0, reg: float = 1.0) -> Trees:
    """Gradient boosting with histograms: cuts are taken at quantiles of each feature, gains from gradient sums by bin."""
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(math.log(p / (1 - p)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    # a feature that is zero almost everywhere still gets the cut between zero and the rest
    edges = [np.unique(np.append(e, [0.0, *np.quantile(c[c > 0], (0.25, 0.5, 0.75), method="lower")] if (c > 0).any() else [0.0])) for e, c in zip(edges, x.T, strict=True)]
    # a cut lies halfway to the next value that occurs, so new values between the two fall to the nearer side
    for k, (e, c) in enumerate(zip(edges, x.T, strict=True)):
        values = np.unique(c)
        above = np.minimum(np.searchsorted(values, e, "right"), len(values) - 1)
        edges[k] = np.unique((e + np.maximum(values[above], e)) / 2)
    codes = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], 1)
    width = max(len(e) for e in edges) + 1
    flat = codes + np.arange(x.shape[1]) * width
    margin = np.full(len(x), model.base)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = y - q, q * (1 - q)
        feature, cutoff, child, value = [-1], [0.0], [0], [0.0]
        todo = [(0, np.arange(len(x)), 0)]
        while todo:
            at, rows, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value[at] = rate * gs / (hs + reg)
            if level < depth and len(rows) > 1:
                f = flat[rows].ravel()
                k = x.shape[1]
                left_g = np.bincount(f, np.repeat(g[rows], k), k * width).reshape(k, width).cumsum(1)[:, :-1]
                left_h = np.bincount(f, np.repeat(h[rows], k), k * width).reshape(k, width).cumsum(1)[:, :-1]
                gain = left_g**2 / (left_h + reg) + (gs - left_g) ** 2 / (hs - left_h + reg) - gs**2 / (hs + reg)
                gain[(left_h < least * 0.05) | (hs - left_h < least * 0.05)] = 0
                best = int(gain.argmax())
                fi, b = divmod(best, width - 1)
                if gain.flat[best] > 1e-6 and b < len(edges[fi]):
                    right = codes[rows, fi] > b
                    feature[at], cutoff[at], child[at] = fi, float(edges[fi][b]), len(feature)
                    for side, part in enumerate((rows[~right], rows[right])):
                        todo.append((len(feature), part, level + 1))
                        feature.append(-1), cutoff.append(0.0), child.append(0), value.append(0.0)
        tree = (np.array(feature, np.int32), np.array(cutoff), np.array(child, np.int32), np.array(value))
        model.trees.append(tree)
        margin += Trees(0.0, [tree]).margin(x)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit (pool adjacent violators) of y on score, each pool at its mean score."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum y, count, sum score
    for s, v in zip(score[order], y[order], strict=True):
        pools.append([v, 1.0, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


@dataclass
class Model:
    words: dict
    starts: dict
    trees: Trees
    knots: np.ndarray
    levels: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated chance of label 1: the isotonic levels, on straight lines between their pools' mean margins, and a fiftieth
        part of the uncalibrated chance, which keeps the texts of one level in order."""
        margin = self.trees.margin(x)
        step = np.interp(margin, self.knots, self.levels)
        return np.clip(0.98 * step + 0.02 / (1 + np.exp(-margin)), 0.0, 1.0)


def strength(t, c, toxic: int, clean: int, log, sqrt):
    """Logarithm of how much more often toxic texts have a key than others, lowered by one and a half of its standard errors, so
    that chance words don't pass. For numbers and for columns, which bring their own log and sqrt."""
    return log((t + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1)) - 1.5 * sqrt(1 / (t + 0.5) + 1 / (c + 0.5))


def lexicon(counts: dict, toxic: int, clean: int, support: int, ratio: float) -> tuple[dict, dict]:
    """Words and beginnings in at least `support` toxic texts whose strength is log(ratio) or more, with it as their weight."""
    words, starts = {}, {}
    for key, (t, c) in counts.items():
        if t >= support and (weight := strength(t, c, toxic, clean, math.log, math.sqrt)) >= math.log(ratio):
            (starts if key[0] == "^" else words)[key[1:]] = weight
    return words, starts


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 24_000, support: int = 3, ratio: float = 4.0) -> Model:
    """Learn from at most about max_rows labelled documents, the same at each run; held-out ones are never read.

    The sample is the labelled rows whose hash of doc_id falls below the share max_rows / (labelled rows). What reaches the
    driver are its dense features, and those of its words that pass for the lexicon or for a fold's, all of them.
    """
    spark = docs.sparkSession
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = cut(known)
    share = min(1.0, max_rows / max(known.count(), 1))
    part = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    part = part.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    rows = cut(docs.select("doc_id", text_or_empty().alias("text")).join(part, "doc_id").select("doc_id", "text", "toxic", "fold"))

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text, toxic, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold")), strict=True):
                words = set(TOKEN.findall(text.lower()))
                keys = {" " + w for w in words} | {"^" + w[:n] for w in words for n in BEGINNINGS if len(w) >= n}
                seen.update((k, fold, toxic) for k in keys)
                if len(seen) > 400_000:
                    yield packed(seen)
                    seen = Counter()
        yield packed(seen)

    def packed(seen: Counter) -> pa.RecordBatch:
        keys = list(seen)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["key", "fold", "toxic", "n"])

    by = mapped(rows.select("text", "toxic", "fold"), count, "key string, fold int, toxic int, n long")
    t = F.sum(F.when(F.col("toxic") > 0, F.col("n")).otherwise(0))
    c = F.sum(F.when(F.col("toxic") <= 0, F.col("n")).otherwise(0))
    folded = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") > 0), F.col("n")).otherwise(0)).alias(f"t{f}") for f in range(FOLDS)]
    folded += [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") <= 0), F.col("n")).otherwise(0)).alias(f"c{f}") for f in range(FOLDS)]
    docs_of = {(r.fold, int(r.toxic > 0)): r.n for r in rows.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = [sum(n for (_, y), n in docs_of.items() if y == k) for k in (0, 1)]
    # only keys that pass, by all rows or without one of the folds, reach the driver
    passes = [(F.col("t"), F.col("c"), total[1], total[0])]
    passes += [(F.col("t") - F.col(f"t{f}"), F.col("c") - F.col(f"c{f}"), total[1] - docs_of.get((f, 1), 0), total[0] - docs_of.get((f, 0), 0)) for f in range(FOLDS)]
    some = reduce(operator.or_, [(a >= support) & (strength(a, b, *n, F.log, F.sqrt) >= math.log(ratio) - 1e-9) for a, b, *n in passes])
    candidates = by.groupBy("key").agg(t.alias("t"), c.alias("c"), *folded).where(some).collect()

    def without(f: int) -> tuple[dict, dict]:
        counts = {r.key: (r.t - (r[f"t{f}"] if f >= 0 else 0), r.c - (r[f"c{f}"] if f >= 0 else 0)) for r in candidates}
        return lexicon(counts, total[1] - docs_of.get((f, 1), 0), total[0] - docs_of.get((f, 0), 0), support, ratio)

    folds = spark.sparkContext.broadcast([without(f) for f in range(FOLDS)])

    def dense(batches):
        weights = [Weights(*x) for x in folds.value]
        for batch in batches:
            x = [features(text, weights[f]) for text, f in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), batch.column("fold"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "toxic", "fold", "x"])

    got = mapped(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic", "fold"), dense, "doc_id long, toxic int, fold int, x array<double>").collect()
    words, starts = without(-1)
    got.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.x))
    if not got or not total[1] or not total[0]:  # one class or no labels: its share is all there is to say
        share = total[1] / max(sum(total), 1)
        return Model(words, starts, Trees(0.0), np.array([0.0]), np.array([share]))
    x, y, fold = np.array([r.x for r in got]), np.array([float(r.toxic > 0) for r in got]), np.array([r.fold for r in got])
    # each fold's margins come from trees fitted without it, and the calibration from all folds together
    margin = np.zeros(len(y))
    for f in range(FOLDS):
        inside = fold == f
        if inside.any():
            margin[inside] = boost(x[~inside], y[~inside]).margin(x[inside]) if (~inside).any() else 0.0
    return Model(words, starts, boost(x, y), *isotonic(margin, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each whole text. Null texts count as empty; equal texts get equal scores; repeated rows each get
    theirs; an empty table gives no rows. Only doc_id and text are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        weights = Weights(model.words, model.starts)
        for batch in batches:
            for part in slices(batch):
                x = np.array([features(t, weights) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    return mapped(texts(docs), run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without the rows that score threshold or more, in its own columns. Rows with null texts are scored as empty; repeated
    rows stay or go together. Texts alone go to Python, whose answer is a score a row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        weights = Weights(model.words, model.starts)
        for column in columns:
            rows = pa.RecordBatch.from_arrays([column], names=["text"])
            parts = [model.score(np.array([features(t or "", weights) for t in part.column(0).to_pylist()])) for part in slices(rows)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.where(scored(F.col("text")) < threshold)
