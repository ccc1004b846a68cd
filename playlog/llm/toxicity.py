"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from a
linear model over its words; the document's probability is their noisy-or
(one toxic sentence suffices). Only document labels are known, so the
gradient of the document loss is passed through the noisy-or to the
sentences, and the sentences that carry a toxic document's score are the
offending ones.

A word counts by itself and by its first 3 to 6 letters, so unseen endings of
a known stem still count. Scores add up per distinct word.

Results for odd input: a null or empty text has no sentence, score 0 and no
offending sentence. A document with several labels counts as toxic if any of
them says so; null labels do not teach. Without labelled documents of both
kinds every score is 0. Repeated rows are scored one by one. Existing
columns that carry a result column's name are replaced by the result.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlog.llm import common as C

_END = re.compile(r"[.!?\n\r]+")
_EDGE = " \t\v\f ,;:.!?\"'()[]{}<>|*#$%&/\\~`^+=_-…«»„“”‘’¿¡"
STEMS = (3, 4, 5, 6)


def words(sentence: str) -> list[str]:
    return [w for t in sentence.split() if (w := t.strip(_EDGE))]


def sentences(text: str) -> list[str]:
    """Non-empty sentences in order, as written."""
    return [s for s in _END.split(text) if s.strip()]


def features(word: str) -> list[str]:
    """The word (marked ``=``) and its stems that are shorter than it."""
    return ["=" + word, *(word[:n] for n in STEMS if len(word) > n)]


@dataclass
class ToxicityModel:
    """Weight by feature, and the weight of a sentence without any."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -60.0

    def word(self, w: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(w))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
           per_class: int = 4000, chars: int = 6_000_000) -> list[tuple[str, int]]:
    """Labelled documents to learn from: of each class the ``per_class`` rows of
    smallest hash that are not held out, as long as their whole texts together
    keep within ``chars`` characters. Rows alike in id and text are one; an id
    with many texts counts by its rows, so both bounds hold for what is collected."""
    keys = C.row_keys(id_col, text)
    rows = docs.filter(F.col(text).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("i"), *keys, F.length(text).alias("n")).distinct()
    known = labels.filter(F.col(label).isNotNull() & ~C.held_out(id_col) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("i")).agg(F.max(F.col(label).cast("int")).alias("y")).filter("y in (0, 1)")
    taught = rows.join(known, "i").withColumn("h", F.xxhash64("i", "k1", "k2"))
    counts = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    few = taught.filter(C.lowest_share(F.col("y"), F.col("h"), counts, per_class))
    first = Window.partitionBy("y").orderBy("h", "k1", "k2")
    few = few.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= per_class).collect()
    chosen, size = {}, {0: 0, 1: 0}
    for r in sorted(few, key=lambda r: (r["y"], r["k"])):
        if size[r["y"]] + r["n"] <= chars:
            size[r["y"]] += r["n"]
            chosen[r["k1"], r["k2"]] = r["y"]
    if not chosen:
        return []
    small = docs.sparkSession.createDataFrame([(*k, y) for k, y in chosen.items()], "k1 long, k2 long, y int")
    got = docs.select(*keys, F.col(text).alias("t")).join(F.broadcast(small), ["k1", "k2"]).groupBy("k1", "k2").agg(
        F.first("t").alias("t"), F.first("y").alias("y")).collect()
    return [(r["t"], r["y"]) for r in sorted(got, key=lambda r: (r["k1"], r["k2"]))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 4000, chars: int = 6_000_000, **training) -> ToxicityModel:
    """Train on a bounded sample (see ``sample``) of the labelled documents."""
    return train(sample(docs, labels, id_col, text, label, per_class, chars), **training)


def train(rows: list[tuple[str, int]], most_features: int = 800, least_share: float = 0.002, steps: int = 400,
          rate: float = 1.0, leak: float = -10.0) -> ToxicityModel:
    """Gradient descent (Adagrad) on the noisy-or's log loss.

    ``leak`` is the fixed weight of a plain sentence: low enough that a
    document of thousands of plain sentences stays near 0. Features that occur
    in fewer than ``least_share`` of the documents (3 at least) are left out;
    of the rest the ``most_features`` that differ most between the classes are
    trained."""
    rows = list(dict.fromkeys(rows))  # copies teach once
    labels = np.array([y for _, y in rows], dtype=np.float64)
    if not len(rows) or labels.min() == labels.max():
        return ToxicityModel()
    kept = _features(rows, labels, max(3, int(least_share * len(rows))), most_features)
    place = {f: i for i, f in enumerate(kept)}
    known: dict[str, list[int]] = {}
    feat, size, owner = array("i"), [], []
    for d, (t, _) in enumerate(rows):
        for s in sentences(t.lower()):
            found: set[int] = set()
            for x in words(s):
                ids = known.get(x)
                if ids is None:
                    ids = known[x] = [place[f] for f in features(x) if f in place]
                found.update(ids)
            feat.extend(sorted(found))
            size.append(len(found))
            owner.append(d)
    if not owner:
        return ToxicityModel()
    feat, owner, n = np.frombuffer(feat, np.int32) if feat else np.zeros(0, np.int32), np.asarray(owner), len(size)
    sent = np.repeat(np.arange(n, dtype=np.int32), size)

    w, b = np.zeros(len(kept)), leak
    gw = np.full(len(kept), 1e-8)
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    for _ in range(steps):
        z = np.bincount(sent, w[feat], n) + b
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        log_none = np.bincount(owner, -np.logaddexp(0, np.clip(z, -60, 60)), len(rows))
        none = np.exp(log_none)
        miss = np.where(labels == 1, -none / np.maximum(1 - none, 1e-12), 1.0) * weight
        g = miss[owner] * p
        dw = np.bincount(feat, g[sent], len(kept))
        gw += dw * dw
        w -= rate * dw / np.sqrt(gw)
    return ToxicityModel({f: float(x) for f, x in zip(kept, w) if abs(x) > 1e-3}, float(b))


def _features(rows: list[tuple[str, int]], labels: np.ndarray, least_docs: int, most: int) -> list[str]:
    """Features that differ most between the classes, by documents with them
    (for a stem: by the sum over the words that begin with it)."""
    in_class: tuple[Counter, Counter] = Counter(), Counter()
    for t, y in rows:
        in_class[y].update(set(words(t.lower())))
    counts: dict[str, list[int]] = {}
    for y in (0, 1):
        for x, k in in_class[y].items():
            for f in features(x):
                counts.setdefault(f, [0, 0])[y] += k
    counts = {f: c for f, c in counts.items() if sum(c) >= least_docs}
    ones, zeros = labels.sum() + 1, (1 - labels).sum() + 1
    worth = {f: abs((c[1] + 0.5) / ones - (c[0] + 0.5) / zeros) / ((sum(c) + 1) / (ones + zeros)) ** 0.5
             for f, c in counts.items()}
    return sorted(sorted(worth, key=lambda f: (-worth[f], f))[:most])


class _Scorer:
    """Word scores of one worker, remembered for up to ``most`` tokens."""

    def __init__(self, model: ToxicityModel, most: int = 300_000):
        self.model, self.most, self.seen = model, most, {}

    def token(self, t: str) -> float:
        w = t.strip(_EDGE)
        s = self.model.word(w) if w else 0.0
        if len(self.seen) < self.most:
            self.seen[t] = s
        return s

    def sentence_scores(self, text: str) -> tuple[list[str], np.ndarray]:
        found, get, token = sentences(text), self.seen.get, self.token
        z = []
        for s in found:
            total = 0.0
            for t in set(s.lower().split()):
                v = get(t)
                total += token(t) if v is None else v
            z.append(total)
        return found, np.asarray(z, dtype=np.float64) + self.model.bias

    def score(self, text: str | None, offending: float) -> tuple[float, list[int], list[str]]:
        found, z = self.sentence_scores(text or "")
        if not found:
            return 0.0, [], []
        z = np.clip(z, -60, 60)
        p = 1 / (1 + np.exp(-z))
        at = np.flatnonzero(p >= offending)
        return float(1 - np.exp(-np.logaddexp(0, z).sum())), at.tolist(), [found[i].strip() for i in at]


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7,
          offending: float = 0.5) -> DataFrame:
    """``docs`` with toxic_score (noisy-or over all sentences), toxic
    (1 from ``threshold`` on), and the numbers and texts of the offending
    sentences (those whose own probability is ``offending`` or more)."""
    results = ("toxic_score", "toxic_pred", "offending_index", "offending_text")
    kept = C.without(docs, *results)
    shared = C.Shared(docs.sparkSession, model, _Scorer)
    names = kept.columns
    out = [kept.schema[c] for c in names] + [C.field(n, k) for n, k in zip(
        results, ("double", "int", "array<int>", "array<string>"))]

    def rows(batch):
        scorer = shared.get()
        for part in C.slices(batch, text):
            found = [scorer.score(t, offending) for t in part.column(names.index(text)).to_pylist()]
            yield {n: part.column(i) for i, n in enumerate(names)} | {
                "toxic_score": [f[0] for f in found], "toxic_pred": [int(f[0] >= threshold) for f in found],
                "offending_index": [f[1] for f in found], "offending_text": [f[2] for f in found]}

    return C.map_arrow(kept, rows, out)
