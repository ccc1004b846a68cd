"""Token-id files: one concatenated id array a shard, with Elias-Fano
encoded document boundaries.

Documents are dealt into id ranges and sorted, each task encodes its range
and writes it as shards of bounded size into the shared folder. A shard holds

    magic "EFTOK001", bytes an id (2 or 4), number of null document ids,
    Elias-Fano code of the document ids (non-decreasing, nulls first),
    Elias-Fano code of the document ends (ids before the end of each),
    the ids of all its documents, little-endian, one after the other.

A shard's name is unique to the attempt that wrote it; the manifest that the
job returns names the shards that count, so a retried or speculative task
leaves at most an unlisted file. Offsets over all shards come from one sum
over the manifest (one row a shard).

``PieceEncoder`` gives the ids that the tokenizers library gives for the whole
text; ``pattern`` is the split pattern of the tokenizer file. Strings of added
tokens in a text (such as ``<|endoftext|>``) give those tokens' ids, as the
library does by default; ``special_as_text`` makes special ones ordinary text.

Results for odd input: a null or empty text is the end id alone. Ids of
documents are integers; null ids come first and repeated ids keep one entry
each, in order of the text's hash. An empty table gives no shard.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.llm import elias_fano
from playlog.session import scratch_path

MAGIC = b"EFTOK001"
_HEAD = struct.Struct("<8sBq")
# a cut before a blank changes the pre-tokens only where the blank is between white space, or ends the text after some
_UNSAFE = re.compile(r"\s \s|\s $")
_MARKS = ".,;:!?"


def _byte_symbols() -> dict[int, str]:
    """Byte -> the character that stands for it in byte-level vocabularies:
    printable Latin-1 stands for itself, the other bytes take 256, 257, ..."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class PieceEncoder:
    """Encodes texts as id bytes with the tokenizers library.

    A text is cut at its blanks, a piece into pre-tokens, and a pre-token goes
    to the library's BPE model once while it is remembered: ``seen`` by the
    piece without the blank before it, ``bare`` pre-tokens without a blank.
    Texts where a cut could matter are encoded whole, and so are texts that hold
    an added token's string, and pieces with characters that the library counts to
    other classes (``apart``: see ``unlike``). Beyond ``most`` pieces only those of the last texts
    stay."""

    def __init__(self, tokenizer_file: str, pattern: str, most: int = 750_000, longest: int = 64,
                 special_as_text: bool = True, apart: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file)
        self.tok.encode_special_tokens = special_as_text
        added = [a.content for a in self.tok.get_added_tokens_decoder().values()
                 if a.content and not (a.special and special_as_text)]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else None
        size = self.tok.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.bytes_of = [i.to_bytes(self.kind.itemsize, "little") for i in range(size)]
        self.symbols, self.model = _byte_symbols(), self.tok.model
        self.blank = self.symbols[32]
        self.marks = {m: self._model(m) for m in _MARKS}
        self.find = regex.compile(pattern).findall
        self.most, self.longest, self.seen, self.bare = most, longest, {}, {}
        spaces, others = apart or unlike(pattern)
        self.spaces, self.apart = C.any_of(spaces), C.any_of(others + spaces)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _model(self, symbols: str) -> bytes:
        table = self.bytes_of
        return b"".join([table[t.id] for t in self.model.tokenize(symbols)])

    def _symbols(self, w: str) -> str:
        return w.encode("utf-8", "replace").decode("latin-1").translate(self.symbols)

    def _word(self, w: str) -> bytes:
        """Ids of any pre-token."""
        blank = w[0] == " " and len(w) > 1 and not w[1].isspace()
        known, key = (self.seen, w[1:]) if blank else (self.bare, w)
        found = known.get(key)
        if found is None:
            found = self._model(self._symbols(w))
            if len(w) <= self.longest:
                known[key] = found
        return found

    def _piece(self, text: str) -> bytes:
        if not text.isascii() and self.apart(text):
            return self._whole(text)  # characters that the library counts to other classes: only it knows how it splits
        word = self._word
        return b"".join([word(w) for w in self.find(text)])

    def _new(self, r: str) -> bytes:
        """Ids of a blank and a piece that is not remembered yet."""
        if r.isalpha() and (r.isascii() or not self.apart(r)):  # letters alone are one pre-token with the blank
            ids = self._model(self.blank + (r if r.isascii() else self._symbols(r)))
        else:
            mark, word = self.marks.get(r[-1:]), r[:-1]
            if mark and word.isalpha() and (word.isascii() or not self.apart(word)):  # a closing mark after letters is a pre-token of its own
                ids = (self.seen.get(word) or self._new(word)) + mark
            else:
                ids = self._piece(" " + r)
        if r and len(r) <= self.longest and not r[0].isspace():
            self.seen[r] = ids
        return ids

    def _text(self, t: str) -> bytes:
        if (self.added and self.added(t)) or (not t.isascii() and self.spaces(t)):
            return self._whole(t)
        pieces, get = t.split(" "), self.seen.get
        ids, unsafe, at = list(map(get, pieces)), False, 0
        ids[0] = self._piece(pieces[0])  # no blank before the first
        for _ in range(ids.count(None)):
            at = ids.index(None, at)
            r = pieces[at]
            unsafe = unsafe or not r or r[0].isspace()  # never remembered, so always met here
            ids[at] = get(r) or self._new(r)
        if unsafe and _UNSAFE.search(t):  # white space after a blank: a cut before that blank may matter
            return self._whole(t)
        return b"".join(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [self._text(t) for t in texts]
        if len(self.seen) > self.most:
            last = {r: self.seen.get(r) for t in texts for r in t.split(" ")}
            self.seen = {r: x for r, x in last.items() if x is not None}
        if len(self.bare) > self.most // 4:
            self.bare = {}
        return out


@lru_cache(8)
def unlike(pattern: str) -> tuple[str, str]:
    """Code points that the tokenizers library counts to other classes of the
    pattern than ``regex`` does: to white space, or to others."""
    from tokenizers import Regex, normalizers

    def members(kind: str) -> str:
        return normalizers.Replace(Regex(f"[^{kind}]+"), "").normalize_str(C.every_character())

    return C.differing(pattern, members)


def _file_system(uri: str):
    """(file system, path) of a shared folder, from inside a task."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def shard_bytes(ids: list[int | None], bodies: list[bytes], kind: np.dtype) -> bytes:
    """One shard; ``ids`` in order, nulls first."""
    nulls = sum(i is None for i in ids)
    ends = np.cumsum([len(b) // kind.itemsize for b in bodies])
    return b"".join([_HEAD.pack(MAGIC, kind.itemsize, nulls),
                     elias_fano.encode(np.asarray(ids[nulls:], np.int64)), elias_fano.encode(ends), *bodies])


class Shard:
    """A shard's documents, read in place."""

    def __init__(self, data: bytes):
        magic, width, self.nulls = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.names = elias_fano.Reader(data, _HEAD.size)
        self.ends = elias_fano.Reader(data, self.names.end)
        self.ids = np.frombuffer(data, f"<u{width}", -1, self.ends.end)

    def __len__(self) -> int:
        return len(self.ends)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def document(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.ids[a:b]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.names[i - self.nulls]


def _encoder(settings: tuple[str, str, bool, tuple[str, str]]) -> PieceEncoder:
    file, pattern, special_as_text, apart = settings
    return PieceEncoder(file, pattern, special_as_text=special_as_text, apart=apart)


def write(docs: DataFrame, tokenizer_file: str, pattern: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
          text: str = "text", most_bytes: int = 4 << 20, special_as_text: bool = False) -> DataFrame:
    """Write the token files; returns the manifest (file, part, seq, n_docs,
    n_ids, base): base is the number of ids of all shards before."""
    spark = docs.sparkSession
    folder = (folder or scratch_path(spark, "tokens")).rstrip("/")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    tie = F.xxhash64("body")
    dealt = src.withColumn("tie", tie).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    encoder = C.Shared(spark, (tokenizer_file, pattern, special_as_text, unlike(pattern)), _encoder)
    out = [C.field(n, k) for n, k in (("file", "string"), ("part", "int"), ("seq", "int"), ("n_docs", "long"),
                                      ("n_ids", "long"))]

    def run(batches):
        from pyspark import TaskContext

        enc, part, seq = encoder.get(), TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], enc.kind).tobytes()
        place, path = _file_system(folder)
        ids, bodies, held = [], [], 0

        def close():
            nonlocal seq, held
            name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.eftok"
            place.create_dir(path, recursive=True)
            with place.open_output_stream(f"{path}/{name}") as f:
                f.write(shard_bytes(ids, bodies, enc.kind))
            row = [[name], [part], [seq], [len(ids)], [sum(map(len, bodies)) // enc.kind.itemsize]]
            seq, held = seq + 1, 0
            ids.clear()
            bodies.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        schema = C.arrow_schema(*out)
        for batch in batches:
            for few in C.slices(batch, "body", 1 << 20):
                found = enc.encode([t or "" for t in few.column(1).to_pylist()])
                for i, b in zip(few.column(0).to_pylist(), found):
                    ids.append(i)
                    bodies.append(b + end)
                    held += len(b) + len(end)
                    if held >= most_bytes:
                        yield close()
            C.trim()
        if ids:
            yield close()

    written = C.cut(dealt.mapInArrow(C.trimmed(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out)))
    # sums within each part, then over the parts (one row a task)
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    base = F.coalesce("earlier", F.lit(0)) + F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    return (written.join(parts, "part").withColumn("base", base.cast("long")).drop("earlier")
            .select("file", "part", "seq", "n_docs", "n_ids", "base").withColumn("folder", F.lit(folder)))


def read(spark: SparkSession, manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of the written shards: file, doc_id, at (ids before it in the
    file), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit
    integers) and, if asked for, those ids."""
    out = [C.field(n, k) for n, k in (("file", "string"), ("doc_id", "long"), ("at", "long"), ("n_tokens", "long"),
                                      ("ids_crc32", "long"), ("ids", "binary"))][:None if with_ids else -1]
    if manifest.isEmpty():
        return spark.createDataFrame([], T.StructType(out))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.eftok").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))

    def rows(batch):
        for name, data in zip(batch.column(0), batch.column(1)):
            s = Shard(data.as_py())
            ends = s.ends.all()
            starts = np.concatenate([[0], ends[:-1]])
            ids = s.ids.astype("<u4")
            names = [None] * s.nulls + s.names.all().tolist()
            for i in range(0, len(s), 2000):
                a, b = starts[i:i + 2000], ends[i:i + 2000]
                each = [ids[x:y] for x, y in zip(a.tolist(), b.tolist())]
                yield {"file": [name.as_py()] * len(a), "doc_id": names[i:i + 2000], "at": a, "n_tokens": b - a,
                       "ids_crc32": list(map(zlib.crc32, each)),
                       "ids": [x.tobytes() for x in each] if with_ids else None}

    return C.map_arrow(files, rows, out)


def located(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """``found`` (columns of ``read``, ids optional) of listed shards only,
    with ``start`` over all shards instead of the place in the file."""
    return found.join(manifest.select("file", "base"), "file").withColumn(
        "start", F.col("base") + F.col("at")).drop("file", "base", "at")
