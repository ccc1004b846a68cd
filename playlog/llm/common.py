"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.session import ensure_checkpoint_dir, table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there:
    computed once, lineage cut, and safe against a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(col: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def row_keys(id_col: str, text: str) -> list[Column]:
    """k1, k2: 128 bits that name a row by its id and text (never null).
    Rows alike in both share them, so a decision holds for all of them."""
    i, t = F.col(id_col).cast("string"), F.col(text).cast("string")
    return [F.xxhash64(i, F.lit("|"), t, t.isNull()).alias("k1"), F.xxhash64(t, F.lit("#"), i, i.isNull()).alias("k2")]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until no column of ``df`` has it."""
    taken, found = {c.lower() for c in df.columns}, []
    for n in names:
        while n in taken:
            n += "_"
        found.append(n)
    return found


def keep_rows(docs: DataFrame, keys: DataFrame, how: str, id_col: str, text: str, once: bool = False) -> DataFrame:
    """Rows of ``docs`` that have (left_semi) or lack (left_anti) their k1, k2
    in ``keys``; ``once`` keeps one of the rows that share them."""
    k1, k2, n = fresh(docs, "k1", "k2", "n")
    keyed = docs.select("*", *[c.alias(x) for c, x in zip(row_keys(id_col, text), (k1, k2))])
    keys = keys.select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    kept = keyed.join(keys, [k1, k2], how)
    if once:
        kept = kept.withColumn(n, F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1))).filter(F.col(n) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that carry a result column's name (any case)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def arrow_schema(*fields: T.StructField) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(list(fields)))


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind) if kind not in _KINDS else _KINDS[kind], True)


_KINDS = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(),
}


def trim() -> None:
    """Give freed memory back to the system: idle Python workers otherwise
    keep the most that any of their tasks held."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run: Callable) -> Callable:
    """A ``mapInArrow`` function that trims when its task is done."""
    def wrapped(batches):
        yield from run(batches)
        trim()

    return wrapped


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]],
              out: list[T.StructField]) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns one batch into dicts of column lists."""
    schema = T.StructType(out)
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(*out)
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=target.field(n).type)
                     for n, c in ((n, cols[n]) for n in names)], schema=target)

    return df.mapInArrow(trimmed(run), schema)


def lowest_share(key: Column, unit_hash: Column, counts: dict, most: int) -> Column:
    """Filter that keeps about four times ``most`` rows of each key: those in
    the lowest part of the hash, given each key's row count. It runs before
    the exact "first ``most`` by hash", which then moves few rows."""
    share = F.lit(False)
    for k, n in counts.items():
        part = 4 * most / max(n, 1)
        low = F.lit(True) if part >= 1 else unit_hash < int(-(1 << 63) + part * (1 << 64))
        share = share | ((key == F.lit(k)) & low)
    return share


@lru_cache(1)
def every_character() -> str:
    """All code points that a text may hold, in order."""
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


def character_classes(pattern: str) -> list[str]:
    r"""The classes of characters that a split pattern names, or names the rest
    of (``\p{L}``, ``\s`` ...)."""
    found = re.findall(r"\\[pP]\{\^?\w+\}|\\[wWdDsS]", pattern)
    return sorted({c[:2].lower() + c[2:].replace("^", "") for c in found})


def differing(pattern: str, members: Callable[[str], str]) -> tuple[str, str]:
    """Code points that ``regex`` counts to a class of the pattern and the other
    splitter does not, or the reverse: of classes of white space, and of others.
    ``members`` gives the code points of one class after the other splitter."""
    import regex

    space, other = set(), set()
    for c in character_classes(pattern):
        found = set(regex.findall(c, every_character())) ^ set(members(c))
        (space if c == r"\s" else other).update(found)
    return "".join(sorted(space)), "".join(sorted(other - space))


def any_of(characters: str) -> Callable[[str], bool]:
    """Tells whether a text holds any of the characters."""
    some = frozenset(characters)
    return (lambda text: not some.isdisjoint(text)) if some else (lambda text: False)


class Shared:
    """A broadcast value and what each worker builds from it once."""

    _built: dict[str, object] = {}  # of this worker; only the latest few stay

    def __init__(self, spark: SparkSession, value, build: Callable = lambda v: v):
        self.token, self.build = uuid.uuid4().hex, build
        self.value = spark.sparkContext.broadcast(value)

    def get(self):
        if self.token not in Shared._built:
            while len(Shared._built) >= 3:
                Shared._built.pop(next(iter(Shared._built)))
            Shared._built[self.token] = self.build(self.value.value)
        return Shared._built[self.token]


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of ``text``
    (a single longer row stays whole), so Python objects stay bounded."""
    col = batch.column(batch.schema.get_field_index(text))
    sizes = pc.binary_length(col).fill_null(0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield batch.slice(start)
