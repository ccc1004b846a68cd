"""Top-k and arg-max with an explicit tie policy (SURVEY WIN-1..WIN-3, WIN-7,
AGG-8, AGG-12, SRT-1..SRT-5).

Works on any DataFrame: value, partition and tie-break columns are
parameters. A rank filter ``<= n`` is planned as ``WindowGroupLimit``: each
map task keeps only its top ``n`` rows per partition before the shuffle, so
a low-cardinality partition (a season, a quarter) does not funnel all rows
into one task.

Tie policies:

* ``first``   -- ``row_number``: exactly ``n`` rows, ties broken by ``tiebreak``.
* ``all``     -- ``rank``: every row tied with the n-th is kept.
* ``dense``   -- ``dense_rank``: the top ``n`` distinct values.
* ``collapse``-- one row per distinct value inside the partition (the
  representative is the smallest ``tiebreak`` tuple), then ``first``. This is
  what value-keyed maps do in the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIES = ("first", "all", "dense", "collapse")


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _order(value_cols: list[str], tiebreak: list[str], descending: bool) -> list[Column]:
    vals = [F.col(v).desc() if descending else F.col(v).asc() for v in value_cols]
    return vals + [F.col(t).asc() for t in tiebreak]


def collapse_ties(df: DataFrame, value_cols, partition_by=None, tiebreak=None) -> DataFrame:
    """AGG-12: keep one row per (partition, value); smallest tie-break tuple wins."""
    value_cols, part, tb = _names(value_cols), _names(partition_by), _names(tiebreak)
    keys = part + value_cols
    rest = tb + [c for c in df.columns if c not in keys and c not in tb]
    rep = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_pl_rep"))
    return rep.select(*keys, *[F.col("_pl_rep")[c].alias(c) for c in rest]).select(*df.columns)


def top_n(df: DataFrame, value_cols, n: int, partition_by=None, ties: str = "first", tiebreak=None,
          rank_col: str | None = "rank", descending: bool = True, collapse_by=None) -> DataFrame:
    """Top ``n`` rows by ``value_cols`` (descending by default) inside each
    ``partition_by`` group (or overall), with a ``rank_col`` column.

    ``collapse_by`` sets the scope of ``ties='collapse'`` (default: the
    ranking partition). An empty list collapses equal values across all
    partitions, as a single value-keyed map over all seasons does: a season's
    leader then disappears when another season has the same total (SURVEY Q2).
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}")
    value_cols, part, tb = _names(value_cols), _names(partition_by), _names(tiebreak)
    if ties == "collapse":
        scope = part if collapse_by is None else _names(collapse_by)
        extra_tb = [c for c in part if c not in scope and c not in tb]
        df = collapse_ties(df, value_cols, scope, tb + extra_tb)
    # rank/dense_rank see ties only among equal values, so the tie-break
    # columns order rows for row_number only.
    order = _order(value_cols, tb if ties in ("first", "collapse") else [], descending)
    w = Window.partitionBy(*part).orderBy(*order) if part else Window.orderBy(*order)
    fn = {"first": F.row_number, "collapse": F.row_number, "all": F.rank, "dense": F.dense_rank}[ties]
    tmp = rank_col or "_pl_rank"
    out = df.withColumn(tmp, fn().over(w).cast("long")).where(F.col(tmp) <= n)
    return out if rank_col else out.drop(tmp)


def leader_per(df: DataFrame, value_cols, partition_by, ties: str = "all", tiebreak=None,
               collapse_by=None) -> DataFrame:
    """AGG-8: the row(s) with the largest value in each partition."""
    return top_n(df, value_cols, 1, partition_by, ties, tiebreak, rank_col=None, collapse_by=collapse_by)


def top_overall(df: DataFrame, value_cols, n: int, tiebreak=None, rank_col: str = "rank") -> DataFrame:
    """SRT-1 + SRT-2 + WIN-7: global top ``n`` (ties broken by ``tiebreak``) with
    its position; planned as a partial top-n per task, then one small merge."""
    return top_n(df, value_cols, n, None, "first", tiebreak, rank_col)


def sort_desc(df: DataFrame, value_cols: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """SRT-3 / SRT-4: descending sort with a full tie-break (a range shuffle)."""
    return df.orderBy(*_order(list(value_cols), list(tiebreak), True))
