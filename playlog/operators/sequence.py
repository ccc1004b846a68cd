"""Ordered running values inside a group, split into bounded chunks.

A running score or a line number is a prefix computation over the rows of one
game. ``Window.partitionBy(game)`` would put every row of a game into one task,
and one game may hold a large share of all rows. Here the order inside a group
is cut into chunks (a column that never decreases along the order):

1. a window partitioned by (group, chunk) computes the running value inside
   each chunk -- one task sees at most one chunk of one game;
2. the same rows are aggregated to one row per (group, chunk): its total,
   count and last non-NULL value;
3. a window over that small table (one row per chunk) carries the totals of
   all earlier chunks forward;
4. an equi-join on (group, chunk) adds the carry to every row. The big side
   is already hash-partitioned on those keys by step 1, so only the small
   side moves. A group column is had back from its key, so that it does not
   move beside it.

Chunks come from a column with a bounded number of rows per value (e.g.
``line_no div 4096``) or, when the order has no such column, from a range
repartition on the order (:func:`with_range_chunks`), whose partitions are
contiguous slices of the order; their number follows the input's size. Range
bounds come from sampling and may differ between two evaluations of the
same plan, so range chunks are checkpointed (written once to the shared
checkpoint folder) before both branches read them.
NULL group keys and NULL chunks are kept (see :func:`prefix_within`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_pl_chunk"
# Bytes of input that make one range chunk, about.
CHUNK_BYTES = 64 << 20


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stand_in(c: Column, dt: T.DataType, ordered: bool) -> Column:
    """``c`` with NULL replaced by a fixed value of the same type (paired with an
    is-NULL flag, so the stand-in never merges with a real value). Group keys
    of other types use their JSON text; the chunk must be orderable."""
    if isinstance(dt, T.StringType):
        d = F.lit("")
    elif isinstance(dt, (T.NumericType, T.BooleanType)):
        d = F.lit(0).cast(dt)
    elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        d = F.lit("1970-01-01").cast(dt)
    elif not ordered:
        return F.to_json(F.struct(c.alias("v")))
    else:
        raise TypeError(f"chunk column of type {dt} is not supported")
    return F.coalesce(c, d)


def with_range_chunks(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, n: int | None = None,
                      chunk_col: str = CHUNK) -> DataFrame:
    """Range-partition on (group, order) and tag each row with its partition id.

    Partition ``i`` holds a contiguous slice of the total order, so the id
    never decreases along the order inside a group, and a group larger than
    one partition is spread over several. Without ``n`` the number of slices
    follows the input: one for each ``CHUNK_BYTES`` of it, at least the
    session's shuffle partitions.
    """
    if n is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n = max(least, -(-input_bytes(df) // CHUNK_BYTES))
    keys = [_c(g) for g in group_cols] + [_c(o) for o in order_cols]
    return df.repartitionByRange(n, *keys).withColumn(chunk_col, F.spark_partition_id())


def input_bytes(df: DataFrame) -> int:
    """Bytes of the rows, about: text and binary columns by length, others 8 each (one aggregate)."""
    sized = [F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType))
             else F.lit(8) for f in df.schema.fields]
    return df.agg(F.sum(sum(sized, F.lit(16)).cast("long"))).first()[0] or 0


def prefix_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence,
    chunk: Column | str,
    sums: Mapping[str, Column] | None = None,
    fills: Mapping[str, Column] | None = None,
    counter: str | None = None,
) -> DataFrame:
    """Add running values over ``order_cols`` inside ``group_cols``.

    * ``sums``: name -> value; inclusive running sum (NULL counts as 0).
    * ``fills``: name -> value; last non-NULL value up to and including the row.
    * ``counter``: name of a 1-based running row number.

    ``order_cols`` must be a total order inside a group; ``chunk`` must not
    decrease along it (a NULL chunk counts as the first one, as NULL orders
    first). NULL group keys form their own group; no row is dropped.
    """
    sums = dict(sums or {})
    fills = dict(fills or {})
    order = [_c(o) for o in order_cols]

    base_cols = [c for c in df.columns if c != CHUNK]
    staged = df.select(
        *base_cols,
        _c(chunk).alias(CHUNK),
        *[v.alias(f"_pl_sv_{k}") for k, v in sums.items()],
        *[v.alias(f"_pl_fv_{k}") for k, v in fills.items()],
        # the order (one struct, or the column itself when there is one), to pick
        # the last non-NULL value per chunk; a plain numeric order keeps the
        # max_by buffer fixed-width, so the summary is a hash aggregate
        (order[0] if len(order) == 1 else F.struct(*order)).alias("_pl_ord"),
    )
    # Non-NULL stand-ins for the group keys and the chunk, with is-NULL flags:
    # the windows and the equi-join below then never meet a NULL key.
    types = {f.name: f.dataType for f in staged.schema.fields}
    keys, extra, back = [], [], {}
    for i, g in enumerate(group_cols):
        extra += [F.col(g).isNull().alias(f"_pl_gn{i}"), _stand_in(F.col(g), types[g], False).alias(f"_pl_g{i}")]
        keys += [f"_pl_gn{i}", f"_pl_g{i}"]
        back[g] = F.when(~F.col(f"_pl_gn{i}"), F.col(f"_pl_g{i}")).alias(g)
    extra += [F.col(CHUNK).isNull().alias("_pl_cn"), _stand_in(F.col(CHUNK), types[CHUNK], True).alias("_pl_c")]
    staged = staged.select("*", *extra)
    # the stand-ins of other types are another form of the value
    back = {g: c for g, c in back.items() if staged.select(c).schema[g].dataType == types[g]}
    group_cols = keys
    chunk_keys = ["_pl_cn", "_pl_c"]

    w_local = Window.partitionBy(*group_cols, *chunk_keys).orderBy(*order)
    w_run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local_exprs = []
    for k in sums:
        local_exprs.append(F.sum(F.coalesce(F.col(f"_pl_sv_{k}"), F.lit(0))).over(w_run).alias(f"_pl_ls_{k}"))
    for k in fills:
        local_exprs.append(F.last(F.col(f"_pl_fv_{k}"), ignorenulls=True).over(w_run).alias(f"_pl_lf_{k}"))
    if counter:
        local_exprs.append(F.row_number().over(w_local).alias("_pl_lc"))
    local = staged.select("*", *local_exprs)

    # one row per (group, chunk)
    aggs = [F.count(F.lit(1)).alias("_pl_tc")]
    for k in sums:
        aggs.append(F.sum(F.coalesce(F.col(f"_pl_sv_{k}"), F.lit(0))).alias(f"_pl_ts_{k}"))
    for k in fills:
        v = F.col(f"_pl_fv_{k}")
        aggs.append(F.max_by(v, F.when(v.isNotNull(), F.col("_pl_ord"))).alias(f"_pl_tf_{k}"))
    summary = local.groupBy(*group_cols, *chunk_keys).agg(*aggs)

    # NULL chunk first, then chunks in order
    w_prev = (Window.partitionBy(*group_cols).orderBy(F.col("_pl_cn").desc(), F.col("_pl_c"))
              .rowsBetween(Window.unboundedPreceding, -1))
    carry_exprs = [F.sum("_pl_tc").over(w_prev).alias("_pl_cc")]
    for k in sums:
        carry_exprs.append(F.sum(f"_pl_ts_{k}").over(w_prev).alias(f"_pl_cs_{k}"))
    for k in fills:
        carry_exprs.append(F.last(f"_pl_tf_{k}", ignorenulls=True).over(w_prev).alias(f"_pl_cf_{k}"))
    carry = summary.select(*group_cols, *chunk_keys, *carry_exprs)

    joined = local.join(carry, on=[*group_cols, *chunk_keys], how="inner")
    out = [back.get(c, F.col(c)) for c in base_cols]
    for k in sums:
        out.append((F.coalesce(F.col(f"_pl_cs_{k}"), F.lit(0)) + F.col(f"_pl_ls_{k}")).alias(k))
    for k in fills:
        out.append(F.coalesce(F.col(f"_pl_lf_{k}"), F.col(f"_pl_cf_{k}")).alias(k))
    if counter:
        out.append((F.coalesce(F.col("_pl_cc"), F.lit(0)) + F.col("_pl_lc")).cast("long").alias(counter))
    return joined.select(*out)


def stable_range_chunks(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                        n: int | None = None) -> DataFrame:
    """:func:`with_range_chunks`, checkpointed so every later reader sees the
    same chunk ids (and a lost executor does not re-sample them)."""
    from playlog.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return with_range_chunks(df, group_cols, order_cols, n).checkpoint(eager=True)


def number_rows(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, name: str,
                n_chunks: int | None = None) -> DataFrame:
    """1-based row number over ``order_cols`` inside ``group_cols`` (``row_number``),
    without sending a whole group to one task."""
    chunked = stable_range_chunks(df, group_cols, order_cols, n_chunks)
    return prefix_within(chunked, group_cols, order_cols, F.col(CHUNK), counter=name)
