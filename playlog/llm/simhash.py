"""SimHash near-duplicates with pigeonhole blocks.

A text is lower-cased (A-Z), cut into words at ASCII white space, and its
word shingles, repeats included, vote with their XXH64 on each of 64 bits.
Fingerprints link when few bits differ. To find the links the 64 bits are
split into ``blocks`` blocks: fingerprints that differ in at most
``distance`` bits agree on at least ``blocks - distance`` whole blocks, so
every choice of that many blocks is a join key and each linked pair meets
under at least one. Fingerprints that meet are verified bit by bit.

Copies of a fingerprint are one node. Inside a bucket only a spanning forest
of the verified links is kept (it has the same components), found in blocks
of rows, so no pair list is ever written. A bucket beyond ``bucket`` rows is
keyed again by a second choice of blocks over its free bits, which bounds
the new buckets by 2 to the power of the bits still free.

Results for odd input: a null or empty text, or one of white space only, has
fingerprint zero and links like any other. A text with fewer words than a
shingle is one shingle. Repeated rows get the same answer each. A null id
keeps its row; a group's id is its smallest non-null id (null if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.llm.graph import components

SEED = 42
_RUN = 1 << 16  # shingles whose votes are counted at once


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts, n = (ends - sizes).tolist(), max(1, len(words) - shingle + 1)
    stops = (ends - 1)[min(shingle, len(words)) - 1:].tolist()
    votes = np.zeros(64, np.int64)
    for i in range(0, n, _RUN):
        h = b"".join([digest(body[a:b], SEED) for a, b in zip(starts[i:min(n, i + _RUN)], stops[i:i + _RUN])])
        votes += np.unpackbits(np.frombuffer(h, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, k1, k2, fp) of every row; see ``common.row_keys`` for k1 and k2."""
    src = docs.select(F.col(id_col).alias("id"), *C.row_keys(id_col, text), C.utf8(text).alias("body"))
    out = [T.StructField("id", src.schema["id"].dataType), *[C.field(n, "long") for n in ("k1", "k2", "fp")]]

    def rows(batch):
        yield {"id": batch.column(0), "k1": batch.column(1), "k2": batch.column(2),
               "fp": [fingerprint(b.as_py(), shingle) for b in batch.column(3)]}

    return C.map_arrow(src, rows, out)


def _masks(bits: list[int], parts: int, chosen: int) -> list[int]:
    """Bit masks of every choice of ``chosen`` out of ``parts`` even parts of ``bits``."""
    cut = [sum(1 << b for b in p) for p in np.array_split(np.array(bits, dtype=object), parts)]
    return [sum(c) for c in combinations(cut, chosen)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    rest = fps
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                yield np.full(len(found), x), found
                front.extend(found)


def _pairs(rows: DataFrame, distance: int, bucket: int | None) -> DataFrame:
    """Verified forest edges (a, b) of the rows (c, k, fp) that share (c, k);
    of a bucket with more than ``bucket`` rows come the rows themselves, as
    (c, k, a), with a null b."""
    out = T.StructType([C.field("c", "int"), C.field("k", "long"), C.field("a", "long"), C.field("b", "long")])
    dealt = rows.repartition("c", "k").sortWithinPartitions("c", "k", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = C.arrow_schema(*out.fields)

        def emit(c, k, a, b):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(k, pa.int64()),
                                               pa.array(a.view(np.int64)), b], schema=schema)

        def close(c, k, fps):
            """A bucket that ended within the bound."""
            edges = list(_forest(np.unique(fps), distance)) if len(fps) > 1 else []
            if edges:
                a, b = (np.concatenate(x) for x in zip(*edges))
                yield emit(np.full(len(a), c), np.full(len(a), k), a, pa.array(b.view(np.int64)))

        open_key, held, over = None, [], False
        for batch in batches:
            c, k, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.astype(np.int64).view(np.uint64)
            if not len(fp):
                continue
            cuts = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
            # inner buckets of one row have no link; only longer ones and the ends of the batch matter
            worth = np.flatnonzero((stops - starts > 1) | (starts == 0) | (stops == len(fp)))
            for i, j in zip(starts[worth].tolist(), stops[worth].tolist()):
                key = (int(c[i]), int(k[i]))
                if key != open_key:
                    if held and not over:
                        yield from close(*open_key, np.concatenate(held))
                    open_key, held, over = key, [], False
                part = fp[i:j]
                if not over:
                    held.append(part)
                    if bucket is not None and sum(map(len, held)) > bucket:
                        over, part, held = True, np.concatenate(held), []
                if over:
                    yield emit(np.full(len(part), key[0]), np.full(len(part), key[1]), part,
                               pa.nulls(len(part), pa.int64()))
        if held and not over:
            yield from close(*open_key, np.concatenate(held))

    return dealt.mapInArrow(C.trimmed(run), out)


def links(fps: DataFrame, distance: int = 3, blocks: int = 6, bucket: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose connected
    components are those of all links of at most ``distance`` bits."""
    distinct = fps.select("fp").distinct()
    chosen = _masks(list(range(64)), blocks, blocks - distance)
    keyed = distinct.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in chosen])).alias("c", "k")).select("c", "k", "fp")
    first = C.cut(_pairs(keyed, distance, bucket))
    near, over = first.filter("b IS NOT NULL").select("a", "b"), first.filter("b IS NULL")
    if over.isEmpty():
        return near
    # the second choice of blocks, among the bits that the first left free
    finer = [[F.col("fp").bitwiseAND(F.lit(_signed(m | s))) for s in _masks(
        [b for b in range(64) if not m >> b & 1], blocks, blocks - distance)] for m in chosen]
    each = F.array(*[F.array(*x) for x in finer])
    again = over.select("c", F.col("a").alias("fp")).select("c", "fp", F.posexplode(each[F.col("c")]).alias("s", "k"))
    width = max(map(len, finer))
    more = _pairs(again.select((F.col("c") * width + F.col("s")).alias("c"), "k", "fp"), distance, None)
    return near.unionByName(more.select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3, blocks: int = 6, bucket: int = 4096) -> DataFrame:
    """(id, k1, k2, fp, root, component) of every row. Rows of one group share
    root; component is the group's smallest id: the smallest reachable over
    links of at most ``distance`` bits, itself included."""
    rows = C.cut(fingerprints(docs, id_col, text, shingle))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(rows, distance, blocks, bucket)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    group = named.join(least, "root").select("fp", "root", "component")
    return rows.join(group, "fp").select("id", "k1", "k2", "fp", "root", "component")


def representatives(found: DataFrame) -> DataFrame:
    """(k1, k2) of one row of each group of ``near_duplicates``: the smallest
    id (nulls last), then the smallest k1, k2."""
    first = F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2"))
    return found.groupBy("root").agg(first.alias("f")).select("f.k1", "f.k2")


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
