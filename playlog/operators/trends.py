"""Change between consecutive periods.

Generic over column names: ``key`` identifies the entity (a player, a
customer), ``order`` is an integer period (a season start year) and ``value``
the measure. Input is one row per (key, period) -- already aggregated -- so a
key holds at most one row per period and its window partition stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def consecutive_diff(df: DataFrame, key, order: str, value: str, label: str | None = None,
                     step: int = 1) -> DataFrame:
    """Pairs (period p, period p + step) of the same key with the change of ``value``.

    ``lag`` over ``partitionBy(key).orderBy(order)``; a pair is kept only when
    the periods are adjacent, so a gap (2006, 2008) gives no pair.
    Output: key, ``{label}_from``, ``{label}_to`` (or ``{order}_from/_to``),
    ``{value}_from``, ``{value}_to``, ``diff``.
    """
    keys = _names(key)
    lab = label or order
    w = Window.partitionBy(*keys).orderBy(order)
    prev = df.select(
        *keys, order, value, *([label] if label and label != order else []),
        F.lag(order).over(w).alias("_pl_prev_order"),
        F.lag(value).over(w).alias("_pl_prev_value"),
        *([F.lag(label).over(w).alias("_pl_prev_label")] if label and label != order else []),
    )
    prev_label = F.col("_pl_prev_label") if label and label != order else F.col("_pl_prev_order")
    return prev.where(F.col(order) - F.col("_pl_prev_order") == step).select(
        *keys,
        prev_label.alias(f"{lab}_from"),
        F.col(lab).alias(f"{lab}_to"),
        F.col("_pl_prev_value").alias(f"{value}_from"),
        F.col(value).alias(f"{value}_to"),
        (F.col(value) - F.col("_pl_prev_value")).alias("diff"),
    )


def consecutive_join(df: DataFrame, key, order: str, value: str, step: int = 1) -> DataFrame:
    """Same pairs as :func:`consecutive_diff`, as an equi-join on
    (key, order + step) -- the self-join form of JN-2."""
    keys = _names(key)
    a = df.select(*keys, F.col(order).alias("_pl_o"), F.col(value).alias(f"{value}_from"))
    b = df.select(*keys, (F.col(order) - step).alias("_pl_o"), F.col(order).alias(f"{order}_to"),
                  F.col(value).alias(f"{value}_to"))
    return a.join(b, [*keys, "_pl_o"]).select(
        *keys, F.col("_pl_o").alias(f"{order}_from"), f"{order}_to", f"{value}_from", f"{value}_to",
        (F.col(f"{value}_to") - F.col(f"{value}_from")).alias("diff"))


def chain(df: DataFrame, key, order: str, value: str, name: str = "chain") -> DataFrame:
    """AGG-13: per key, the array of (order, value) sorted by ``order``.

    The array holds one element per period of one key, so its length is
    bounded by the number of periods, not by the data size.
    """
    keys = _names(key)
    return df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value)))).alias(name))


def periods_with_neighbour(df: DataFrame, key, order: str, step: int = 1) -> DataFrame:
    """Rows whose period has an adjacent period (p - step or p + step) for the
    same key -- the periods that take part in at least one pair. One window
    over ``key``; a later ``groupBy(key)`` reuses its partitioning."""
    keys = _names(key)
    w = Window.partitionBy(*keys).orderBy(order)
    prev_gap = F.col(order) - F.lag(order).over(w)
    next_gap = F.lead(order).over(w) - F.col(order)
    return df.select("*", prev_gap.alias("_pl_pg"), next_gap.alias("_pl_ng")).where(
        (F.col("_pl_pg") == step) | (F.col("_pl_ng") == step)).drop("_pl_pg", "_pl_ng")


def periods_in_pairs(pairs: DataFrame, key, order_from: str, order_to: str, value_from: str,
                     value_to: str, order: str, value: str) -> DataFrame:
    """The (key, period, value) rows that take part in at least one pair, each once."""
    keys = _names(key)
    a = pairs.select(*keys, F.col(order_from).alias(order), F.col(value_from).alias(value))
    b = pairs.select(*keys, F.col(order_to).alias(order), F.col(value_to).alias(value))
    return a.unionByName(b).dropDuplicates([*keys, order])
