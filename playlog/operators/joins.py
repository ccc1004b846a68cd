"""Lookup joins: one plan whatever the size of the lookup table, and one for hot keys."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# NULL-key rows of a shuffled left join are spread over this many salt values.
NULL_KEY_SALTS = 1024


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join ``left`` to a lookup table ``right`` on ``keys``.

    Keys compare as Spark compares them (an int key meets an equal double).
    The result has the columns of ``left`` in order, then those of ``right``
    that are not keys. Catalyst and AQE choose broadcast or shuffle by their
    byte thresholds (estimated, then measured); rows and columns do not
    depend on the choice.

    When shuffled, rows of ``left`` with a NULL key cannot match; a salt column
    (0 for all other rows and for ``right``) spreads them over many tasks
    instead of hashing them all to one. Hot non-NULL keys are split by AQE's
    skew-join handling.
    """
    extra = [c for c in right.columns if c not in keys]
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    spread = F.pmod(F.hash(*[F.col(c) for c in left.columns]), F.lit(NULL_KEY_SALTS)) + 1
    salted = left.withColumn("_pl_salt", F.when(null_key, spread).otherwise(F.lit(0))) if how == "left" else left
    lookup = right.select(*keys, *extra)
    on = list(keys)
    if how == "left":
        # always 0, but not a literal: the optimizer keeps it as a join key
        lookup = lookup.withColumn("_pl_salt", F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(1)))
        on.append("_pl_salt")
    a, b = salted.alias("_pl_l"), lookup.alias("_pl_r")
    cond = reduce(lambda x, y: x & y, [F.col(f"_pl_l.{k}") == F.col(f"_pl_r.{k}") for k in on])
    return a.join(b, cond, how).select(*[F.col(f"_pl_l.{c}") for c in left.columns],
                                       *[F.col(f"_pl_r.{c}") for c in extra])


# Keys that the sketch reports at most, and what it keeps count of.
MOST_HOT, TRACKED = 256, 65_536


def _key_text(df: DataFrame, keys: list[str]) -> F.Column:
    """The keys as one text, NULL where one of them is."""
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    return F.when(~null_key, F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)])))


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.01) -> dict[str, int]:
    """Keys that hold at least ``share`` of the rows, about, with their counts: from
    one pass with a heavy-hitter sketch of fixed size (at most MOST_HOT keys)."""
    found = df.select(_key_text(df, keys).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {MOST_HOT}, {TRACKED})").alias("top")).first()
    least = max(share * found["n"], 2)
    return {r["item"]: r["count"] for r in found["top"] if r["item"] is not None and r["count"] >= least}


def salted_lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", share: float = 0.01,
                       rows_a_salt: int = 1_000_000, hot: dict[str, int] | None = None) -> DataFrame:
    """:func:`lookup_join` for probe sides with hot keys, for plans that can't count on
    AQE to split them (streams, AQE off, joins under an aggregate).

    The rows of a hot key are dealt over salts, one for each ``rows_a_salt`` of its
    rows and two at least; its lookup rows are repeated for each of them. Cold keys
    have the salt 0 on both sides and meet as they would without. The same rows and
    columns come out as from ``lookup_join``. ``hot``: keys found before (``hot_keys``).
    """
    hot = hot_keys(left, keys, share) if hot is None else hot
    if not hot:
        return lookup_join(left, right, keys, how)
    spread = F.lit(0)
    for k, n in hot.items():
        spread = F.when(F.col("_pl_key") == F.lit(k), max(2, -(-n // rows_a_salt))).otherwise(spread)
    dealt = left.withColumn("_pl_key", _key_text(left, keys)).withColumn("_pl_spread", spread)
    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.greatest(F.col("_pl_spread"), F.lit(1)))
    dealt = dealt.select(*left.columns, hashed.cast("int").alias("_pl_part"))
    lookup = right.withColumn("_pl_key", _key_text(right, keys)).withColumn("_pl_spread", F.greatest(spread, F.lit(1)))
    lookup = lookup.select(*right.columns, F.explode(F.sequence(F.lit(0), F.col("_pl_spread") - 1)).alias("_pl_part"))
    return lookup_join(dealt, lookup, [*keys, "_pl_part"], how).drop("_pl_part")
