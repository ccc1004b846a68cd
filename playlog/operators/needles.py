"""Many search texts at once.

``plans.queries.count_lines_containing`` has one aggregate column a needle,
which is right for a few. Here all needles form one automaton that reads each
line once, whatever their number: tasks count over Arrow batches, and one row a
needle and task is summed up. Needles are sent to the tasks in blocks of at
most ``block_bytes`` of text; more needles make more blocks, a scan each.

A line counts once for each needle that it contains. A null line contains
nothing, every other one contains the empty needle; null needles give no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 16 << 20


def automaton(needles: Sequence[str]) -> ahocorasick.Automaton | None:
    """Finds the numbers of the needles in a text; None where there is no needle."""
    if not needles:
        return None
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, n in enumerate(needles):
        found.add_word(n, i)
    found.make_automaton()
    return found


def _blocks(needles: DataFrame, col: str, block_bytes: int) -> Iterator[list[str]]:
    """The distinct needles, in blocks of about ``block_bytes``."""
    distinct = needles.select(F.col(col).cast("string").alias("needle")).filter("needle is not null").distinct()
    size = distinct.agg(F.sum(F.octet_length("needle") + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("needle"), F.lit(n))
    for b in range(n):
        yield sorted(r["needle"] for r in distinct.filter(block == b).collect())


def _needles(df: DataFrame, needles: Sequence[str] | DataFrame, col: str, block_bytes: int) -> Iterator[list[str]]:
    if not isinstance(needles, DataFrame):
        needles = df.sparkSession.createDataFrame([(n,) for n in needles], f"{col} string")
    return _blocks(needles, col, block_bytes)


def count_lines(lines: DataFrame, needles: Sequence[str] | DataFrame, col: str = "value", needle_col: str = "needle",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(needle, n): the lines that contain each distinct needle, 0 included."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("n", T.LongType())])
    out = None
    for block in _needles(lines, needles, needle_col, block_bytes):
        texts = [n for n in block if n]
        shared = lines.sparkSession.sparkContext.broadcast(texts)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = automaton(shared.value)
            for batch in batches:
                n = [0] * (len(shared.value) + 1)
                for line in batch.column(0).to_pylist():
                    if line is not None:
                        n[-1] += 1  # contains the empty needle
                        for i in {i for _, i in found.iter(line)} if found else ():
                            n[i] += 1
                hit = [i for i, x in enumerate(n) if x]
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array([n[i] for i in hit], pa.int64())],
                                                 names=["i", "n"])

        counts = lines.select(F.col(col).cast("string")).mapInArrow(count, schema).groupBy("i").agg(F.sum("n").alias("n"))
        names = lines.sparkSession.createDataFrame(
            [(i, t) for i, t in enumerate(texts)] + ([(len(texts), "")] if "" in block else []), "i int, needle string")
        part = names.join(counts, "i", "left").select("needle", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def with_needles(lines: DataFrame, needles: Sequence[str], col: str = "value", name: str = "needles") -> DataFrame:
    """``lines`` with the distinct needles that each contains, sorted; a filter on
    ``size(needles) > 0`` keeps the lines that contain any. The needles are one block."""
    texts = sorted({n for n in needles if n})
    always = [""] if "" in needles else []
    shared = lines.sparkSession.sparkContext.broadcast(texts)
    kept = lines.drop(name)
    at = kept.columns.index(col)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.ArrayType(T.StringType()))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shared.value)
        for batch in batches:
            hits = [[] if line is None else always + [shared.value[i] for i in sorted(
                {i for _, i in found.iter(line)} if found else ())] for line in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.string()))], names=schema.names)

    return kept.mapInArrow(find, schema)
