"""Byte-level BPE over a global shuffle of distinct words.

Every text is exploded into pre-tokens with their positions, but what leaves
a task is compact: for each block of documents the distinct words, and the
positions as a sequence of word numbers. The words are dealt by hash, so all
uses of a word meet in one partition, which encodes each distinct word once
and sends its ids back to every block that asked. The block's ids are joined
to its positions, and the documents are reassembled in order.

A frequent word costs one entry a block, however often it occurs. The texts
are exploded twice, once for the words and once for the positions: that moves
less data than storing the positions in between. Both readings must see the
same rows in the same order, so pass a stored table (files, or a
checkpoint). A block is named by a digest of its words, so a reading that
differs finds no words and stops the job instead of mixing up ids.

Which characters are letters, numbers or white space depends on the Unicode
version of whoever splits. The code points on which the splitter here and that
of the tiktoken library differ are found by comparing the two over all code
points; a piece that holds one is a word as a whole, and the library splits it.

Decoding joins each id to the token-byte table (as many rows as the rank file
has; it is sent to every task and joined there inside each id array).

Results for odd input: a null or empty text has no ids and decodes to no
bytes. Repeated rows and repeated or null ids keep one row each. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C

# a cut before a blank may change the pre-tokens only here: a blank between white space, or one that ends the text
_UNSAFE = re.compile(r"\s \s|\s $")


def read_ranks(spark: SparkSession, rank_file: str) -> dict[bytes, int]:
    """Rank file: a line for each token, its bytes in base64 and its id."""
    with open(rank_file, "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}


_DIGEST = 8
KNOWN = 1 << 20  # words of a bucket that a task remembers at once; beyond it a word may be encoded again


@lru_cache(8)
def unlike(pattern: str) -> tuple[str, str]:
    """Code points that the tiktoken library counts to other classes of the
    pattern than ``regex`` does: to white space, or to others."""
    import tiktoken

    def members(kind: str) -> str:
        # an encoding that knows single bytes and drops what its pattern does not match
        only = tiktoken.Encoding("class", pat_str=f"{kind}+", mergeable_ranks={bytes([b]): b for b in range(256)},
                                 special_tokens={})
        return bytes(only.encode_ordinary(C.every_character())).decode()

    return C.differing(pattern, members)


def plain_letters(pattern: str) -> bool:
    """Whether a blank and the ASCII letters after it are one match of the pattern:
    only its alternatives that begin with an apostrophe come before ` ?\\p{L}+`."""
    before, letters, _ = f"|{pattern}|".partition(r"| ?\p{L}+|")
    return bool(letters) and "(" not in before and all(x.startswith("'") for x in before.split("|") if x)


class _Words:
    """Pre-tokens of the texts of one block, numbered by first use. Pieces that
    hold a character of ``apart`` stay whole, and so do texts with one of ``spaces``.
    ``plain``: a blank and ASCII letters are one pre-token, which needn't be looked for."""

    def __init__(self, find, spaces: str = "", apart: str = "", longest: int = 64, plain: bool = False):
        self.find, self.longest, self.plain = find, longest, plain
        self.spaces, self.apart = C.any_of(spaces), C.any_of(apart + spaces)
        # no byte below this begins one of those characters, so texts of smaller bytes needn't be looked through
        self.lead = min((c.encode()[0] for c in apart + spaces), default=256)
        self.number: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}

    def _codes(self, text: str, watch: bool = True) -> bytes:
        number = self.number
        found = [text] if watch and not text.isascii() and self.apart(text) else self.find(text)
        if len(found) == 1:
            return number.setdefault(found[0], len(number)).to_bytes(4, sys.byteorder)
        return array("I", [number.setdefault(w, len(number)) for w in found]).tobytes()

    def text(self, t: str) -> bytes:
        """The word numbers of a text in order, 32 bits each."""
        if not t:
            return b""
        watch = not t.isascii() and int(np.frombuffer(t.encode("utf-8", "replace"), np.uint8).max()) >= self.lead
        if _UNSAFE.search(t) or (watch and self.spaces(t)):
            return self._codes(t, watch)
        head, *rest = t.split(" ")
        out, pieces, number, plain = [self._codes(head, watch)], self.pieces, self.number, self.plain
        for r in rest:
            c = pieces.get(r)
            if c is None:
                if plain and r.isascii() and r.isalpha():
                    c = number.setdefault(" " + r, len(number)).to_bytes(4, sys.byteorder)
                else:
                    c = self._codes(" " + r, watch)
                if len(r) <= self.longest:
                    pieces[r] = c
            out.append(c)
        return b"".join(out)


def _planes(x: np.ndarray, width: int) -> bytes:
    """Byte planes of unsigned integers, compressed."""
    data = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unplanes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel()


def _pack(items: list[bytes]) -> bytes:
    """Byte strings with their lengths, compressed."""
    sizes = np.fromiter(map(len, items), np.uint32, len(items))
    return zstandard.ZstdCompressor(level=3).compress(b"".join([
        np.uint32(len(items)).tobytes(), np.ascontiguousarray(sizes.view(np.uint8).reshape(-1, 4).T).tobytes(), *items]))


def _unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    """(ends, all bytes) of packed byte strings."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    sizes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(sizes, dtype=np.int64), raw[4 + 4 * n:]


def _blocks(src: DataFrame, pattern: str, buckets: int, block_bytes: int, emit, schema: T.StructType) -> DataFrame:
    """``emit(block, rows, number of words of each text, word numbers, words,
    bucket of each word, digest)`` of every block. Frequent words have small
    numbers. The digest comes from the block's words in order, its name from
    those and the keys of its rows, so that blocks of alike words, or of no
    words, are dealt apart."""
    (spaces, apart), plain = unlike(pattern), plain_letters(pattern)

    def run(batches):
        find = regex.compile(pattern).findall
        out = C.arrow_schema(*schema.fields)
        for batch in batches:
            for part in C.slices(batch, "body", block_bytes):
                words = _Words(find, spaces, apart, plain=plain)
                texts = [words.text(b.as_py().decode("utf-8", "replace")) for b in part.column(3)]
                codes = np.frombuffer(b"".join(texts), np.uint32)
                names = [w.encode("utf-8", "replace") for w in words.number]
                order = np.argsort(-np.bincount(codes, minlength=len(names)), kind="stable") if names else []
                rank = np.empty(len(names), np.uint32)
                rank[order] = np.arange(len(names), dtype=np.uint32)
                names = [names[i] for i in order]
                bucket = np.fromiter((zlib.crc32(w) % buckets for w in names), np.uint16, len(names))
                digest = hashlib.blake2b(_pack(names), digest_size=_DIGEST).digest()
                rows = b"".join(part.column(k).to_numpy().tobytes() for k in (1, 2))
                block = int.from_bytes(hashlib.blake2b(digest + rows, digest_size=8).digest(), "little", signed=True)
                sizes = [len(t) // 4 for t in texts]
                del words, texts
                cols = emit(block, part, sizes, rank[codes], names, bucket, digest)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return src.mapInArrow(C.trimmed(run), schema)


def _words_of(src: DataFrame, pattern: str, buckets: int, block_bytes: int) -> DataFrame:
    """Each block's distinct words by bucket, in order of their numbers."""

    def emit(block, part, sizes, codes, names, bucket, digest):
        by = np.argsort(bucket, kind="stable")
        groups = np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else []
        return ([block] * len(groups), [int(bucket[g[0]]) for g in groups],
                [digest + _pack([names[i] for i in g]) for g in groups])

    return _blocks(src, pattern, buckets, block_bytes, emit, T.StructType([
        C.field("block", "long"), C.field("bucket", "int"), C.field("data", "binary")]))


def _positions_of(src: DataFrame, pattern: str, buckets: int, block_bytes: int) -> DataFrame:
    """Each block's documents (id, k1, k2, number of words), the bucket of each
    word, and the word numbers in text order."""
    doc = T.StructType([*src.schema.fields[:3], C.field("n", "long")])

    def emit(block, part, sizes, codes, names, bucket, digest):
        docs = [{"id": i, "k1": a, "k2": b, "n": n} for i, a, b, n in zip(
            *(part.column(k).to_pylist() for k in range(3)), sizes)]
        return [block], [1], [-1], [digest + _planes(codes, 4)], [docs], [_planes(bucket, 2)]

    return _blocks(src, pattern, buckets, block_bytes, emit, T.StructType([
        C.field("block", "long"), C.field("kind", "int"), C.field("bucket", "int"), C.field("data", "binary"),
        T.StructField("docs", T.ArrayType(doc)), C.field("bucket_of", "binary")]))


class _Encoder:
    def __init__(self, value):
        import tiktoken

        pattern, ranks = value
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoded_words(words: DataFrame, encoder: C.Shared) -> DataFrame:
    """The ids of each block's words, from one encoding of each distinct word."""
    dealt = words.select("bucket", "block", "data").repartition("bucket").sortWithinPartitions("bucket", "block")
    out = [C.field(n, k) for n, k in (("block", "long"), ("kind", "int"), ("bucket", "int"), ("data", "binary"))]

    def run(batches):
        schema, at, known = C.arrow_schema(*out), None, {}
        encode = encoder.get().encoding.encode_ordinary
        for batch in batches:
            found = []
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                if bucket != at:
                    at, known = bucket, {}
                data = data.as_py()
                ends, body = _unpack(data[_DIGEST:])
                ids, a = [], 0
                for b in ends.tolist():
                    w = body[a:b]
                    x = known.get(w)
                    if x is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        x = known[w] = np.asarray(encode(w.decode("utf-8", "replace")), np.uint32).tobytes()
                    ids.append(x)
                    a = b
                found.append(data[:_DIGEST] + zstandard.ZstdCompressor(level=3).compress(b"".join([
                    np.uint32(len(ids)).tobytes(), (np.fromiter(map(len, ids), np.uint32, len(ids)) // 4).tobytes(),
                    _planes(np.frombuffer(b"".join(ids), np.uint32), 4)])))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([0] * len(found), pa.int32()), batch.column(0),
                                              pa.array(found, pa.binary())], schema=schema)

    return dealt.mapInArrow(C.trimmed(run), T.StructType(out))


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text: str = "text",
           block_bytes: int = 8 << 20, buckets: int | None = None) -> DataFrame:
    """One row for each document: id, k1, k2 (``common.row_keys``), n_tokens
    and ids (little-endian unsigned 32-bit integers)."""
    spark = docs.sparkSession
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16)
    encoder = C.Shared(spark, (pattern, read_ranks(spark, rank_file)), _Encoder)
    src = docs.select(F.col(id_col).alias("id"), *C.row_keys(id_col, text), C.utf8(text).alias("body"))
    ids = _encoded_words(_words_of(src, pattern, buckets, block_bytes), encoder)
    positions = _positions_of(src, pattern, buckets, block_bytes)
    doc = positions.schema["docs"].dataType
    both = ids.withColumns({"docs": F.lit(None).cast(doc), "bucket_of": F.lit(None).cast("binary")}).unionByName(
        positions)
    dealt = both.repartition("block").sortWithinPartitions("block", "kind", "bucket")
    out = [*doc.elementType.fields[:3], C.field("n_tokens", "long"), C.field("ids", "binary")]

    def run(batches):
        schema, mine, held = C.arrow_schema(*out), None, {}
        for batch in batches:
            for block, kind, bucket, data, of, words in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                    batch.column(3), batch.column(5), batch.column(4)):
                if block != mine:
                    mine, held = block, {}
                if kind == 0:
                    held[bucket] = data.as_py()
                else:
                    yield from _assembled(held, words.as_py(), of.as_py(), data.as_py(), schema)

    return dealt.mapInArrow(C.trimmed(run), T.StructType(out))


def _assembled(held, docs, bucket_of, data, schema, most: int = 4 << 20):
    """Documents of one block, their words replaced by ids in order."""
    bucket = _unplanes(bucket_of, 2)
    size, start = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
    by = np.argsort(bucket, kind="stable")
    begin = np.searchsorted(bucket[by], np.arange(1 << 16))
    flat, base = [], 0
    data, digest = data[_DIGEST:], data[:_DIGEST]
    if any(x[:_DIGEST] != digest for x in held.values()) or len(held) != len(np.unique(bucket)):
        raise RuntimeError("the documents were read in another order the second time; pass a stored table")
    for b, packed in held.items():
        packed = packed[_DIGEST:]
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(raw, np.uint32, 1)[0])
        sizes = np.frombuffer(raw, np.uint32, n, 4).astype(np.int64)
        mine = by[begin[b]:begin[b] + n]
        size[mine], start[mine] = sizes, base + np.cumsum(sizes) - sizes
        flat.append(_unplanes(raw[4 + 4 * n:], 4))
        base += int(sizes.sum())
    flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    codes, at, rows, done = _unplanes(data, 4), 0, [], 0

    def batch():
        cols = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for d in docs:
        c = codes[at:at + d["n"]]
        at += d["n"]
        n = size[c]
        total = int(n.sum())
        ids = flat[np.repeat(start[c] - np.cumsum(n) + n, n) + np.arange(total)].astype("<u4").tobytes()
        rows.append((d["id"], d["k1"], d["k2"], total, ids))
        done += len(ids)
        if done >= most:
            yield batch()
            rows, done = [], 0
    if rows:
        yield batch()


def _token_bytes(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {i: t for t, i in ranks.items()}


def decode(encoded: DataFrame, rank_file: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``result``; null where
    the ids are null or one of them is not in the table."""
    table = C.Shared(encoded.sparkSession, read_ranks(encoded.sparkSession, rank_file), _token_bytes)
    kept = C.without(encoded, result)
    names = kept.columns
    out = [*kept.schema.fields, C.field(result, "binary")]

    def joined(data: bytes | None, get) -> bytes | None:
        try:
            return None if data is None else b"".join(map(get, np.frombuffer(data, "<u4").tolist()))
        except KeyError:
            return None

    def rows(batch):
        get = table.get().__getitem__
        for part in C.slices(batch, ids):
            yield {n: part.column(i) for i, n in enumerate(names)} | {
                result: [joined(x.as_py(), get) for x in part.column(names.index(ids))]}

    return C.map_arrow(kept, rows, out)
