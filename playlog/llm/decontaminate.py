"""Benchmark decontamination by a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item (an item of fewer
words, but not none, is one window). A document word inside any occurrence of
a window is hit. Texts are lower-cased (A-Z); a word is a run of ASCII
letters, digits and non-ASCII characters.

1. Shingles of the windows are counted over all documents; a fixed-size bit
   filter of the shingles keeps the count small.
2. Each window's shingles are ordered by rarity. For exact containment the
   rarest one is the whole necessary prefix: where it does not occur, the
   window does not. Windows whose rarest shingle occurs nowhere are done.
3. Documents emit the positions of prefix shingles (again through a bit filter
   of fixed size, so nothing that grows is broadcast) with the words around
   them. They join the prefixes on the shingle; positional bounds (the window
   must begin at or after the first word and end by the last) and the length
   bound (the document must be as long as the window) are checked, then the
   words themselves.

Copies of an item are one class, expanded to item ids at the end only.

Results for odd input: null, empty and wordless texts have no words, no hits;
an item without words has no window; an item with a null id still hits but is
not listed or counted. Repeated document rows get the same answer each;
repeated item rows count once by id. An empty benchmark hits nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C

SHINGLE = 3
_WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256))
FILTER_BITS = 24  # 2 MB as a bit array


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def _codes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, ws), np.uint32, len(ws)).astype(np.uint64)


def _shingles(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit keys of the runs of ``n`` words."""
    m = len(codes) - n + 1
    key = np.full(max(m, 0), n, np.uint64)
    for i in range(n if m > 0 else 0):
        key = (key ^ codes[i:i + m]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Fixed-size bit array of a ``key`` column; at most 2**(FILTER_BITS - 6) words are collected."""
    bit = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    found = keys.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(key & 63 as int))").alias("b")
                        ).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for r in found:
        bits[r["w"]] = r["b"] & 0xFFFFFFFFFFFFFFFF
    return bits


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _windows(items: DataFrame, item_id: str, text: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(members: class, item), (windows: class, body, len, keys of its shingles in order)."""
    src = items.select(F.col(item_id).cast("string").alias("item"), C.utf8(text).alias("text"))

    def rows(batch):
        yield {"item": batch.column(0), "body": [b" ".join(words(t.as_py())).decode("utf-8", "replace")
                                                 for t in batch.column(1)]}

    named = C.cut(C.map_arrow(src, rows, [C.field("item", "string"), C.field("body", "string")])
                  .filter("body <> ''").withColumn("class", F.sha2("body", 256)).distinct())

    def cut(batch):
        cls, body, length, keys = [], [], [], []
        for c, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ws = [w.encode() for w in b.split(" ")]
            n = min(size, len(ws))
            k = min(SHINGLE, n)
            all_keys = _shingles(_codes(ws), k).view(np.int64)
            for i in range(len(ws) - n + 1):
                cls.append(c)
                body.append(b" ".join(ws[i:i + n]).decode())
                length.append(n)
                keys.append(all_keys[i:i + n - k + 1].tolist())
        yield {"class": cls, "body": body, "len": length, "keys": keys}

    wins = C.map_arrow(named.select("class", "body").distinct(), cut, [
        C.field("class", "string"), C.field("body", "string"), C.field("len", "int"), C.field("keys", "array<bigint>")])
    return named.select("class", "item"), wins.distinct()


class _Doc:
    """The words of a run of documents in one list, with each document's range."""

    def __init__(self, batch, col: int):
        self.words, self.begin = [], [0]
        for t in batch.column(col):
            self.words += words(t.as_py())
            self.begin.append(len(self.words))
        self.codes, self.begin = _codes(self.words), np.asarray(self.begin)

    def found(self, bits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, position, key) of the shingles of ``n`` words that pass the filter."""
        keys = _shingles(self.codes, n)
        at = np.flatnonzero(_passes(bits, keys)) if len(keys) else np.zeros(0, np.int64)
        doc = np.searchsorted(self.begin, at, side="right") - 1
        whole = at + n <= self.begin[doc + 1]
        return doc[whole], at[whole], keys[at[whole]]


def _counted(docs: DataFrame, text: str, bits: C.Shared, lengths: list[int]) -> DataFrame:
    """(key, n): occurrences over all documents of the shingles in the filter."""

    def rows(batch):
        for part in C.slices(batch, "body"):
            d = _Doc(part, 0)
            found = [d.found(bits.get(), n)[2] for n in lengths]
            key, n = np.unique(np.concatenate(found), return_counts=True)
            yield {"key": key.view(np.int64), "n": n}

    return C.map_arrow(docs.select(C.utf8(text).alias("body")), rows, [C.field("key", "long"), C.field("n", "long")]
                       ).groupBy("key").agg(F.sum("n").alias("n"))


_CANDIDATES = "array<struct<key:bigint,pos:int,start:int,around:string>>"


def _located(docs: DataFrame, id_col: str, text: str, bits: C.Shared, lengths: list[int], size: int) -> DataFrame:
    """One row for each document: id, k1, k2, n_words and its candidate positions
    with the words around them, from ``start`` on."""
    src = docs.select(F.col(id_col).alias("id"), *C.row_keys(id_col, text), C.utf8(text).alias("body"))
    out = [T.StructField("id", src.schema["id"].dataType), C.field("k1", "long"), C.field("k2", "long"),
           C.field("n_words", "long"), C.field("found", _CANDIDATES)]

    def rows(batch):
        for part in C.slices(batch, "body"):
            d = _Doc(part, 3)
            found = [[] for _ in range(part.num_rows)]
            for n in lengths:
                for doc, at, key in zip(*(x.tolist() for x in _signed(d.found(bits.get(), n)))):
                    lo, hi = int(d.begin[doc]), int(d.begin[doc + 1])
                    first = max(lo, at - (size - n))
                    around = b" ".join(d.words[first:min(hi, at + size)])
                    found[doc].append({"key": key, "pos": at - lo, "start": first - lo,
                                       "around": around.decode("utf-8", "replace")})
            yield {"id": part.column(0), "k1": part.column(1), "k2": part.column(2),
                   "n_words": np.diff(d.begin), "found": found}

    return C.map_arrow(src, rows, out)


def _signed(found):
    doc, at, key = found
    return doc, at, key.view(np.int64)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """One row for each document row: id, k1, k2 (see ``common.row_keys``),
    n_words, n_hit (words inside any occurrence of a window), spans (merged
    hits as [start, stop) word ranges) and items (ids of the items with
    occurring windows, sorted as strings)."""
    spark = docs.sparkSession
    members, wins = _windows(items, item_id, item_text, size)
    wins = C.cut(wins)
    lengths = [r["n"] for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("n")).distinct().collect()]

    # rarity over all documents, then each window's necessary prefix
    each = wins.select("body", "len", F.posexplode("keys").alias("off", "key")).distinct()
    counted = _counted(docs, text, C.Shared(spark, _bit_filter(each)), lengths) if lengths else None
    if counted is None:
        prefix = each.select("body", "len", "off", "key")
    else:
        rarest = each.join(counted, "key").groupBy("body", "len").agg(
            F.count("*").alias("known"), F.min(F.struct("n", "key", "off")).alias("p"))
        whole = F.col("len") - F.least("len", F.lit(SHINGLE)) + 1  # every shingle must occur somewhere
        prefix = rarest.filter(F.col("known") == whole).select("body", "len", "p.off", "p.key")
    prefix = C.cut(prefix)

    rows = C.cut(_located(docs, id_col, text, C.Shared(spark, _bit_filter(prefix)), lengths, size)
                 ).withColumn("row", F.monotonically_increasing_id())
    begin = F.col("c.pos") - F.col("off")
    inside = F.slice(F.split("c.around", " "), begin - F.col("c.start") + 1, F.col("len"))
    hits = (rows.filter(F.size("found") > 0).select("row", "n_words", F.explode("found").alias("c"))
            .join(prefix, F.col("c.key") == F.col("key"))
            .filter((F.col("n_words") >= F.col("len")) & (begin >= 0) & (begin + F.col("len") <= F.col("n_words")))
            .filter(F.array_join(inside, " ") == F.col("body"))
            .select("row", "body", begin.alias("start"), (begin + F.col("len")).alias("stop")))
    hits = C.cut(hits)

    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("s"))
    merged = F.aggregate("s", F.expr("cast(array() as array<struct<start:int,stop:int>>)"), _merge)
    spans = spans.select("row", merged.alias("spans"))
    listed = (hits.select("row", "body").distinct().join(wins.select("body", "class").distinct(), "body")
              .select("row", "class").distinct().join(members, "class")
              .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    return (rows.select("row", "id", "k1", "k2", "n_words").join(spans, "row", "left").join(listed, "row", "left")
            .select("id", "k1", "k2", "n_words", F.coalesce("spans", none).alias("spans"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
            .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"),
                                             lambda n, x: n + (x["stop"] - x["start"]))))


def _merge(done, x):
    last = F.element_at(done, -1)
    joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
    return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= x["start"]),
                  F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
        F.concat(done, F.array(x)))
