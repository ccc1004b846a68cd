"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes from a learned rotation (principal axes, then the
rotation that loses least by taking signs). A code is cut into substrings and
each substring has its own index; how many follows from the rows and the learned
radius (long substrings where few bits differ, short ones where many do). By the pigeonhole principle
a code within Hamming radius r of the query's agrees with it in some substring
up to r // parts bits, so probing every substring value that close retrieves
every code within the radius. Retrieved rows are checked on the whole code and
ranked by exact Euclidean distance on the original vectors.

The rotation and the radius come from a bounded sample (documented at
``fit``); every row is indexed. Rows and probes meet by (substring, value); a
bucket with more than ``bucket`` rows is split, and its probes go to every
part. A task keeps the nearest row of k ids a query, so no candidate list is
written. Queries that the radius leaves with fewer than k ids are searched
again over all rows of one index.

Results for odd input: vectors that are null, zero, of another length than
most, or hold null or non-finite components take no part. Rows with the
query's own id are not its neighbours; an id that occurs in several rows
counts once, by its nearest; an id that asks in several rows has the nearest
of any of them. Ties go to the smaller id. Distances of components beyond about
1e154 are infinite. An empty table gives an empty result; with fewer than k
other rows all are returned.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C


@dataclass(frozen=True)
class Codes:
    """Sign codes: bit j of a vector x is set where (x - mean) @ axes[:, j] > 0."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int
    parts: int

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    @property
    def width(self) -> int:
        return self.bits // self.parts

    @property
    def near(self) -> int:
        """Bits that may differ in a substring that is probed."""
        return self.radius // self.parts

    def retrieves(self, query: np.ndarray, code: np.ndarray) -> np.ndarray:
        """For each code the number of substrings by which the query's probes meet it."""
        differ = np.unpackbits(query ^ code, axis=1).reshape(len(code), self.parts, self.width)
        return (differ.sum(axis=2) <= self.near).sum(axis=1)

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes as (rows, bits / 8) bytes."""
        return np.packbits((x - self.mean) @ self.axes > 0, axis=1)

    def substrings(self, code: np.ndarray) -> np.ndarray:
        """(rows, parts) substring values."""
        bits = np.unpackbits(code, axis=1).reshape(len(code), self.parts, self.width)
        return bits @ (1 << np.arange(self.width - 1, -1, -1, dtype=np.int64))


def usable(vec: str, length: int) -> Column:
    v = F.col(vec)
    number = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) == length) & number & F.exists(v, lambda x: x != 0), F.lit(False))


def _itq(x: np.ndarray, bits: int, rng: np.random.Generator, rounds: int = 40) -> np.ndarray:
    """Axes for ``bits`` signs (at most as many as dimensions)."""
    _, axes = np.linalg.eigh(x.T @ x / len(x))
    p = axes[:, ::-1][:, :bits]
    y = x @ p
    r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(y @ r > 0, 1.0, -1.0).T @ y)
        r = (u @ vt).T
    return p @ r


# Substrings that a code of 64 bits may be cut into; a probe, which carries its query's vector through a shuffle,
# costs about as much as this many meetings.
PARTS = (4, 8, 16)
PROBE = 64.0
# Rows that a bucket holds before it is split; entries that are written at a time, however many a row has.
BUCKET = 8192
ENTRIES = 8192


def _cut(codes: Codes, code: np.ndarray, n: int, choices: tuple[int, ...], bucket: int = BUCKET) -> Codes:
    """The cut with the least work a query, by probes (one to each part of a split
    bucket) and by what they meet among the sample's codes, carried on to ``n``
    rows. Every radius up to the next multiple of the parts costs the same probes,
    so the radius goes up to it."""
    best = None
    for parts in choices:
        radius = min(codes.bits, (codes.radius // parts + 1) * parts - 1)
        c = replace(codes, parts=parts, radius=radius)
        split = max(1, -(-n // (bucket << c.width)))
        probes = parts * sum(comb(c.width, i) for i in range(c.near + 1)) * split
        met = np.mean([c.retrieves(q[None], code).sum() for q in code[:64]]) / len(code) * n
        work = PROBE * probes + met
        if best is None or work < best[0]:
            best = work, c
    return best[1]


def fit(rows: DataFrame, k: int = 10, bits: int = 64, parts: int | None = None, sample: int = 4000,
        target: float = 0.97, seed: int = 7, bucket: int = BUCKET) -> Codes | None:
    """Learn from the ``sample`` rows (id, vec) of smallest id hash; ``parts``
    fixes the number of substrings, which else follows from the rows and the radius.

    The radius is the smallest at which ``target`` of the sample's true k
    nearest pairs lie within it. Neighbours in a sample are farther than in the
    whole table, so the radius errs to the wide side there."""
    low = rows.select("id", "vec", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(sample).collect()
    if not low:
        return None
    x = np.array([r["vec"] for r in low], dtype=np.float64)
    mean, rng, axes = x.mean(axis=0), np.random.default_rng(seed), []
    while sum(a.shape[1] for a in axes) < bits:
        axes.append(_itq(x - mean, min(x.shape[1], bits - sum(a.shape[1] for a in axes)), rng))
    first = Codes(mean, np.concatenate(axes, axis=1), bits, parts or 8)
    code = first.of(x)
    far = []
    for i in range(min(len(x), 1000)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        far.append(np.bitwise_count(code[near] ^ code[i]).sum(axis=1, dtype=np.int64))
    far = np.sort(np.concatenate(far)) if len(x) > 1 else np.array([bits])
    radius = int(far[min(len(far) - 1, int(np.ceil(target * len(far))) - 1)])
    choices = (parts,) if parts else tuple(p for p in PARTS if bits % p == 0 and bits // p <= 16)
    return _cut(replace(first, radius=radius), code, rows.count(), choices, bucket)


_ROW = [("part", "int"), ("value", "int"), ("salt", "int"), ("kind", "int"), ("id", "long"), ("code", "binary")]
_OUT = [("query_id", "long"), ("id", "long"), ("distance", "double")]


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls as a matrix."""
    flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.array(x.ravel(), pa.float64()).cast(kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), flat)


def _mixed(ids: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """A number from 0 to 2 ** 31 - 1 for each row by id and vector, so that rows of one id spread."""
    odd = np.random.default_rng(5).integers(1 << 62, size=vec.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bits = np.ascontiguousarray(vec + 0.0).view(np.uint64)
    bits = bits ^ bits >> np.uint64(29)  # narrow floats fill only the high bits
    h = (bits * odd).sum(axis=1, dtype=np.uint64) + ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(33)).astype(np.int64)


def _few(batch: pa.RecordBatch, codes: Codes, most: int):
    """Ids, vectors, codes and substrings of ``most`` rows at a time."""
    for at in range(0, batch.num_rows, most):
        some = batch.slice(at, most)
        vec = _matrix(some.column(1))
        code = codes.of(vec)
        yield some.column(0).to_numpy(zero_copy_only=False), vec, code, codes.substrings(code)


def _sizes(rows: DataFrame, codes: C.Shared) -> DataFrame:
    """part, value, count: the rows of each bucket."""

    def run(batch):
        c = codes.get()
        for _, _, _, sub in _few(batch, c, 4096):
            for part in range(c.parts):
                value, n = np.unique(sub[:, part], return_counts=True)
                yield {"part": np.full(len(value), part), "value": value, "count": n}

    counted = C.map_arrow(rows, run, [C.field("part", "int"), C.field("value", "int"), C.field("count", "long")])
    return counted.groupBy("part", "value").agg(F.sum("count").alias("count"))


def _spread(rows: DataFrame, codes: C.Shared, salts: C.Shared, kind: int, everything: bool = False) -> DataFrame:
    """The index entries of rows (kind 0), or the probes of queries (kind 1).

    ``everything``: all rows are one bucket, split by its salts, that every query
    probes. A query has as many probes as there are buckets near it, which grows
    with the table; they are written ``ENTRIES`` at a time."""
    single = isinstance(rows.schema["vec"].dataType.elementType, T.FloatType)
    numbers = pa.float32() if single else pa.float64()

    def run(batch):
        if not batch.num_rows:
            return
        c, n_salts = codes.get(), salts.get()
        flips = np.array([sum(1 << b for b in f) for n in range(c.near + 1 if kind and not everything else 1)
                          for f in combinations(range(c.width), n)])
        for ids, vec, code, sub in _few(batch, c, max(1, min(256, ENTRIES // len(flips)))):
            mixed = None if kind else _mixed(ids, vec)
            code = np.array([x.tobytes() for x in code], object)
            for part, of_part in enumerate(np.zeros((1, len(sub)), np.int64) if everything else sub.T):
                row, value = np.repeat(np.arange(len(sub)), len(flips)), (of_part[:, None] ^ flips).ravel()
                split = n_salts[part, value]
                if kind:
                    row, value = np.repeat(row, split), np.repeat(value, split)
                    salt = np.arange(len(row)) - np.repeat(np.cumsum(split) - split, split)
                else:
                    salt = mixed % split
                for at in range(0, len(row), ENTRIES):
                    some = slice(at, at + ENTRIES)
                    r = row[some]
                    yield {"part": np.full(len(r), part), "value": value[some], "salt": salt[some],
                           "kind": np.full(len(r), kind), "id": ids[r], "code": code[r], "vec": _lists(vec[r], numbers)}

    return C.map_arrow(rows, run, [*[C.field(*f) for f in _ROW], C.field("vec", "array<float>" if single else "array<double>")])


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_keys])
    return new


def _top(query: np.ndarray, row: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Places of the nearest row of each of the k nearest ids of each query."""
    order = np.lexsort((dist, row, query))
    order = order[_starts(query[order], row[order])]
    order = order[np.lexsort((row[order], dist[order], query[order]))]
    first = np.flatnonzero(_starts(query[order]))
    nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[nth < k]


class _Bucket:
    """Finds, inside one bucket, the rows of each query that this bucket owns."""

    def __init__(self, codes: Codes, part: int, everything: bool, k: int):
        self.codes, self.part, self.all, self.k = codes, part, everything, k

    def search(self, ids, code, vec, q_ids, q_code, q_vec):
        """(query ids, row ids, distances), at most k ids a query, each by its nearest row."""
        c, near, out = self.codes, self.codes.near, []
        for at in range(0, len(ids), 4096):
            some = slice(at, at + 4096)
            differ = q_code[:, None, :] ^ code[None, some, :]
            if self.all:
                fit = np.ones(differ.shape[:2], bool)
            else:
                fit = np.bitwise_count(differ).sum(axis=2, dtype=np.int64) <= c.radius
                for p in range(self.part):  # the first index that retrieves a pair owns it
                    fit &= self._within(differ, p) > near
            fit &= q_ids[:, None] != ids[None, some]
            # candidates by a fast distance, with room for its rounding; then exactly
            d2 = (q_vec ** 2).sum(1)[:, None] + (vec[some] ** 2).sum(1)[None] - 2 * q_vec @ vec[some].T
            d2[~fit] = np.inf
            by = np.argsort(ids[some], kind="stable")
            each = np.flatnonzero(_starts(ids[some][by]))
            least = d2 if len(each) == len(by) else np.minimum.reduceat(d2[:, by], each, axis=1)  # of each id
            last = min(self.k, least.shape[1]) - 1
            edge = np.partition(least, last, axis=1)[:, last]
            slack = 1e-9 * ((q_vec ** 2).sum(1) + (vec[some] ** 2).sum(1).max(initial=0))
            q, r = np.nonzero(fit & (d2 <= (edge + slack)[:, None]))
            dist = np.empty(len(q))
            for i in range(0, len(q), 1 << 14):  # copies of a near row can make many pairs
                few = slice(i, i + (1 << 14))
                dist[few] = np.sqrt(((q_vec[q[few]] - vec[some][r[few]]) ** 2).sum(axis=1))
            best = _top(q_ids[q], ids[some][r], dist, self.k)
            out.append((q_ids[q][best], ids[some][r][best], dist[best]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _within(self, differ: np.ndarray, p: int) -> np.ndarray:
        """Differing bits of substring p."""
        w = self.codes.width
        if 8 % w == 0:
            byte, bit = divmod(p * w, 8)
            return np.bitwise_count(differ[..., byte] & np.uint8((1 << 8 - bit) - (1 << 8 - bit - w)))
        if w % 8 == 0:
            return np.bitwise_count(differ[..., p * w // 8:(p + 1) * w // 8]).sum(axis=2, dtype=np.int64)
        return np.unpackbits(differ, axis=2)[..., p * w:(p + 1) * w].sum(axis=2, dtype=np.int64)


def _search(index: DataFrame, probes: DataFrame, codes: C.Shared, everything: bool, k: int) -> DataFrame:
    """The k nearest of what the probes retrieve: query_id, id, distance."""
    keys = ("part", "value", "salt")
    dealt = index.unionByName(probes).repartition(*keys).sortWithinPartitions(*keys, "kind")
    out = [C.field(*f) for f in _OUT]

    def run(batches):
        schema, at, held, best, size = C.arrow_schema(*out), None, [], [], 0

        def shrunk(found):
            q, r, d = (np.concatenate(x) for x in zip(*found))
            keep = _top(q, r, d, k)
            return [(q[keep], r[keep], d[keep])]

        for batch in batches:
            part, value, salt, kind, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            cols = np.stack([part, value, salt, kind])
            cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            vec = _matrix(batch.column(6))
            code = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                key, mine = (int(part[i]), int(value[i]), int(salt[i])), (ids[i:j], code[i:j], vec[i:j])
                if key != at:
                    at, held = key, []
                if kind[i] == 0:
                    held.append(mine)
                elif held:
                    held = [tuple(np.concatenate(x) for x in zip(*held))]
                    b = _Bucket(codes.get(), key[0], everything, k)
                    for q in range(0, j - i, 256):
                        found = b.search(*held[0], *(x[q:q + 256] for x in mine))
                        best.append(found)
                        size += len(found[0])
                    if size > 500_000:
                        best = shrunk(best)
                        size = len(best[0][0]) // 2
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in shrunk(best)[0]], schema=schema)

    return dealt.mapInArrow(C.trimmed(run), T.StructType(out))


def neighbours(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
               bits: int = 64, parts: int | None = None, bucket: int = BUCKET, **learning) -> DataFrame:
    """query_id, rank (from 1), id, distance: for each row where ``queries``
    holds, the k nearest found among all other rows."""
    spark = vectors.sparkSession
    lengths = vectors.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("n")).count().orderBy(
        F.desc("count"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, distance double")
    if not lengths:
        return empty
    good = vectors.filter(usable(vec_col, lengths[0]["n"]) & F.col(id_col).isNotNull())
    # floats stay floats where they are moved, half as large, and are doubles where they are compared
    numbers = "float" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "double"
    vec = F.col(vec_col).cast(f"array<{numbers}>").alias("vec")
    rows = good.select(F.col(id_col).cast("long").alias("id"), vec)
    asked = good.filter(queries).select(F.col(id_col).cast("long").alias("id"), vec)
    model = fit(rows, k, bits, parts, bucket=bucket, **learning)
    if model is None:
        return empty
    codes = C.Shared(spark, model)
    # one number for each bucket: at most parts x 2 ** width, 262,144
    sizes = _sizes(rows, codes).collect()
    split = np.zeros((model.parts, 1 << model.width), np.int64)  # none: nothing to probe
    for r in sizes:
        split[r["part"], r["value"]] = -(-r["count"] // bucket)
    salts = C.Shared(spark, split)
    found = C.cut(_ranked(_search(_spread(rows, codes, salts, 0), _spread(asked, codes, salts, 1), codes, False, k), k))
    enough = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = C.cut(asked.join(enough, "id", "left_anti"))
    if short.isEmpty():
        return found
    n = sum(r["count"] for r in sizes if r["part"] == 0)
    whole = C.Shared(spark, np.array([[-(-n // bucket)]]))
    again = _search(_spread(rows, codes, whole, 0, True), _spread(short, codes, whole, 1, True), codes, True, k)
    rest = _ranked(again, k)
    return found.join(enough, found["query_id"] == enough["id"], "left_semi").unionByName(rest)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "distance")
