"""Masked pseudo-likelihood of documents under a bidirectional window network.

Tokens are the bytes of the UTF-8 text. A small network (a table for each of
the two bytes before and the two after, a tanh layer, a softmax over bytes)
predicts every byte from both sides; a document's score is the sum of the
conditional log-probabilities of all its bytes.

Training uses every window of every document: windows are counted over the
corpus (first inside each task, then by a shuffle), so the network sees each
distinct window once a round, weighted by its count. Each round, every task
takes gradient steps over its share of the distinct windows from the same
start, and the shares' weights are averaged by a second shuffle. The driver
holds one network. Scoring evaluates each distinct window of a task once.

Results for odd input: a null or empty text has no tokens, log_prob 0 and null
means. Beyond either end of a text the network sees byte 0. An empty corpus
leaves the untrained network. Repeated rows count and score one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C

SIDE = 2  # bytes on either side
SLICE = 2 << 20  # bytes of text whose windows are held at once
_CHUNKS = 16  # parts of a network that are averaged apart


@dataclass
class Network:
    """Tables (2 * SIDE, 256, hidden), hidden bias, output (hidden, 256), output bias."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (2 * SIDE, 256, hidden)), np.zeros(hidden),
                   rng.normal(0, 0.2, (hidden, 256)), np.zeros(256))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray, like: Network) -> Network:
        at, parts = 0, []
        for p in like.parts():
            parts.append(flat[at:at + p.size].reshape(p.shape).copy())
            at += p.size
        return cls(*parts)

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        """tanh layer of contexts (n, 2 * SIDE)."""
        return np.tanh(sum(self.table[p, ctx[:, p]] for p in range(2 * SIDE)) + self.bias)

    def log_probs(self, ctx: np.ndarray) -> np.ndarray:
        z = self.hidden(ctx) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(window of every byte as an integer, number of bytes of each text).

    From the low end: the byte, then the bytes before it (near to far), then
    those after it (near to far)."""
    gap = b"\0" * SIDE
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    x = np.frombuffer(gap + gap.join(bodies) + gap, np.uint8).astype(np.int64)
    n = len(x) - 2 * SIDE
    code = x[SIDE:SIDE + n].copy()
    for i in range(1, SIDE + 1):
        code |= x[SIDE - i:SIDE - i + n] << 8 * i
        code |= x[SIDE + i:SIDE + i + n] << 8 * (SIDE + i)
    real = np.ones(n, bool)
    ends = np.cumsum(sizes + SIDE) - SIDE  # of each text in ``code``
    for i in range(SIDE):
        real[ends[:-1] + i] = False
    return code[real], sizes


def _split(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, bytes) of window codes."""
    return np.stack([code >> 8 * (i + 1) & 255 for i in range(2 * SIDE)], axis=1), code & 255


def _body(batch: pa.RecordBatch, col: int) -> list[bytes]:
    return [b.as_py() for b in batch.column(col)]


def count_windows(docs: DataFrame, text: str = "text", most: int = 2_000_000) -> DataFrame:
    """(code, n): how often each window occurs in the whole corpus."""
    schema = T.StructType([C.field("code", "long"), C.field("n", "long")])

    def run(batches):
        out = C.arrow_schema(*schema.fields)
        code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in C.slices(batch, "body", SLICE):
                new, count = np.unique(windows(_body(part, 0))[0], return_counts=True)
                both = np.concatenate([code, new])
                code, where = np.unique(both, return_inverse=True)
                n = np.bincount(where, np.concatenate([n, count]), len(code)).astype(np.int64)
                if len(code) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], schema=out)
                    code, n = code[:0], n[:0]
        if len(code):
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], schema=out)

    return docs.select(C.utf8(text).alias("body")).mapInArrow(C.trimmed(run), schema).groupBy("code").agg(
        F.sum("n").alias("n"))


def _descend(net: Network, code: np.ndarray, n: np.ndarray, rate: float, batch: int, seed: int) -> Network:
    """One pass of Adam steps over weighted windows; few windows take smaller
    batches, so that a pass has about 64 steps at least."""
    batch = max(16, min(batch, len(code) // 64))
    rng, parts = np.random.default_rng(seed), net.parts()
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    order, weight = rng.permutation(len(code)), n / n.mean()
    for at in range(0, len(order), batch):
        pick = order[at:at + batch]
        ctx, byte = _split(code[pick])
        w = weight[pick] / len(pick)
        h = net.hidden(ctx)
        z = h @ net.out + net.out_bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(pick)), byte] -= 1
        p *= w[:, None]
        back = p @ net.out.T * (1 - h * h)
        table = np.zeros_like(net.table)
        for i in range(2 * SIDE):
            by = np.argsort(ctx[:, i], kind="stable")
            seen, begin = np.unique(ctx[by, i], return_index=True)
            table[i, seen] = np.add.reduceat(back[by], begin, axis=0)
        step += 1
        for k, g in enumerate((table, back.sum(axis=0), h.T @ p, p.sum(axis=0))):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            parts[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return net


def _round(shares: DataFrame, net: Network, rate: float, batch: int, seed: int) -> Network:
    """One pass of every share from ``net``; the shares' mean, weighted by their windows."""
    start = C.Shared(shares.sparkSession, net)
    schema = T.StructType([C.field("chunk", "int"), C.field("weight", "double"), C.field("data", "binary")])

    def run(batches):
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        code, n = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(code)  # the same steps whatever order the rows came in
        mine = start.get()
        flat = _descend(Network.of(mine.flat(), mine), code[order], n[order].astype(np.float64), rate, batch, seed).flat()
        mass = float(n.sum())
        yield pa.RecordBatch.from_arrays([
            pa.array(range(_CHUNKS), pa.int32()), pa.array([mass] * _CHUNKS),
            pa.array([(c * mass).tobytes() for c in np.array_split(flat, _CHUNKS)], pa.binary())],
            schema=C.arrow_schema(*schema.fields))

    def add(batches):
        total: dict[int, list] = {}
        for b in batches:
            for chunk, weight, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                x = np.frombuffer(data.as_py())
                held = total.setdefault(chunk, [0.0, np.zeros(len(x))])
                held[0] += weight
                held[1] += x
        if total:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(total), pa.int32()), pa.array([t[0] for t in total.values()]),
                pa.array([t[1].tobytes() for t in total.values()], pa.binary())], schema=C.arrow_schema(*schema.fields))

    rows = shares.mapInArrow(C.trimmed(run), schema).repartition("chunk").mapInArrow(C.trimmed(add), schema).collect()
    mean = [np.frombuffer(r["data"]) / r["weight"] for r in sorted(rows, key=lambda r: r["chunk"])]
    return Network.of(np.concatenate(mean), net)


def fit(docs: DataFrame, text: str = "text", hidden: int = 32, rounds: int = 6, rate: float = 0.02, batch: int = 2048,
        share: int = 200_000, seed: int = 11) -> Network:
    """Train on the counted windows of all documents. ``share`` distinct
    windows, about, make one task, so a task's memory has a bound."""
    counts = C.cut(count_windows(docs, text))
    net, distinct = Network.fresh(hidden, seed), counts.count()
    if not distinct:
        return net
    # dealt by hash: the same rows meet in every round
    shares = C.cut(counts.repartition(-(-distinct // share), "code"))
    for i in range(rounds):
        net = _round(shares, net, rate * 0.6 ** i, batch, seed + i)
    return net


class _Scorer:
    """Log-probabilities of windows, remembered in sorted order up to ``most``."""

    def __init__(self, net: Network, most: int = 3_000_000):
        self.net, self.most = net, most
        self.code, self.value = np.zeros(0, np.int64), np.zeros(0, np.float64)

    def of(self, code: np.ndarray) -> np.ndarray:
        """Log-probabilities of distinct sorted windows."""
        at = np.searchsorted(self.code, code)
        known = np.zeros(len(code), bool)
        if len(self.code):
            known = self.code[np.minimum(at, len(self.code) - 1)] == code
        value = np.empty(len(code))
        value[known] = self.value[at[known]]
        new = np.flatnonzero(~known)
        for i in range(0, len(new), 4096):
            some = new[i:i + 4096]
            ctx, byte = _split(code[some])
            value[some] = self.net.log_probs(ctx)[np.arange(len(some)), byte]
        if len(new):
            if len(self.code) + len(new) > self.most:
                self.code, self.value = code, value
            else:
                both = np.concatenate([self.code, code[new]])
                order = np.argsort(both, kind="stable")
                self.code, self.value = both[order], np.concatenate([self.value, value[new]])[order]
        return value

    def texts(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, summed log-probability) of each text."""
        code, sizes = windows(bodies)
        distinct, where = np.unique(code, return_inverse=True)
        each = np.append(self.of(distinct)[where], 0.0)
        ends = np.cumsum(sizes)
        total = np.add.reduceat(each, ends - sizes) if len(sizes) else np.zeros(0)
        return sizes, np.where(sizes > 0, total, 0.0)


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with lm_tokens, lm_log_prob (natural logarithm, summed over
    all bytes), lm_mean (a token) and lm_perplexity (null without tokens)."""
    results = ("lm_tokens", "lm_log_prob")
    kept = C.without(docs, *results, "lm_mean", "lm_perplexity")
    body, = C.fresh(kept, "lm_body")
    src = kept.withColumn(body, C.utf8(text))
    shared = C.Shared(docs.sparkSession, net, _Scorer)
    out = [*kept.schema.fields, C.field("lm_tokens", "long"), C.field("lm_log_prob", "double")]
    names = kept.columns

    def rows(batch):
        for part in C.slices(batch, body, SLICE):
            sizes, total = shared.get().texts(_body(part, len(names)))
            yield {n: part.column(i) for i, n in enumerate(names)} | {"lm_tokens": sizes, "lm_log_prob": total}

    mean = F.when(F.col("lm_tokens") > 0, F.col("lm_log_prob") / F.col("lm_tokens"))
    return C.map_arrow(src, rows, out).withColumn("lm_mean", mean).withColumn("lm_perplexity", F.exp(-F.col("lm_mean")))
