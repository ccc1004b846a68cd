"""Per (player, season) aggregates.

Each metric selects its key columns and value (PRJ-3) and filters the
qualifying events *before* grouping (FLT-6): only resolved players are
grouped, so no sentinel key is shuffled. The source's minimum key lengths
(FLT-7) are replaced by the same NULL-player filter. Grouping uses
hash aggregation with a partial (map-side) step, so a hot player costs one
row per map task, not one row per event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.functions.scalars import TYPE_POINT

KEYS = ("player", "season_start", "season")


def season_filter(df: DataFrame, seasons: Sequence[str] | None) -> DataFrame:
    """FLT-9: keep the listed seasons (``'2006/2007'`` labels). The start years
    are filtered too, which prunes season folders of a stored event table."""
    if seasons is None:
        return df
    labels = list(seasons)
    starts = sorted({int(s.split("/")[0]) for s in labels})
    return df.where(F.col("season_start").isin(starts) & F.col("season").isin(labels))


def _resolved(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    return season_filter(events.where(F.col("player").isNotNull()), seasons)


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def points_by_player_season(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """AGG-2: points of point events per (player, season)."""
    return (_resolved(events, seasons).where(F.col("type") == TYPE_POINT)
            .groupBy(*KEYS).agg(F.sum("points").cast("long").alias("points")))


def misses_by_player_season(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """AGG-3: missed attempts per (player, season)."""
    return (_resolved(events, seasons).where(F.col("is_missed"))
            .groupBy(*KEYS).agg(F.count(F.lit(1)).cast("long").alias("misses")))


def makes_by_player_season(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """AGG-4: made baskets per (player, season); a point event without PTS
    still creates the key with 0 (SURVEY Q15)."""
    return (_resolved(events, seasons).where(F.col("type") == TYPE_POINT)
            .groupBy(*KEYS).agg(_count_if(F.col("is_made")).alias("makes")))


def fouls_by_player_season(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """AGG-5: personal fouls per (player, season)."""
    return (_resolved(events, seasons).where(F.col("is_foul"))
            .groupBy(*KEYS).agg(F.count(F.lit(1)).cast("long").alias("fouls")))


def buzzer_by_player_season(events: DataFrame, seasons: Sequence[str] | None = None,
                            include_overtime: bool = True) -> DataFrame:
    """AGG-6: baskets in the last 12 seconds; players with only free throws
    there keep a row with 0."""
    df = _resolved(events, seasons).where(F.col("is_buzzer"))
    if not include_overtime:
        df = df.where(~F.col("is_ot"))
    return df.groupBy(*KEYS).agg(F.sum("buzzer_value").cast("long").alias("baskets"))


def quarter_points(events: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """AGG-7: points per (quarter, player, season); unparsable clocks (NULL
    quarter) are dropped before grouping."""
    return (_resolved(events, seasons).where((F.col("type") == TYPE_POINT) & F.col("quarter").isNotNull())
            .groupBy("quarter", *KEYS).agg(F.sum("points").cast("long").alias("points")))


def shooting_ratio(events: DataFrame, min_attempts: int = 300, seasons: Sequence[str] | None = None) -> DataFrame:
    """JN-1 + FN-10 + FLT-8: makes / (makes + misses) per (player, season).

    One pass with two conditional counts replaces the source's two keyed sums
    and their join: a key needs a point event (the makes side) and a miss
    (the misses side). Kept when attempts > ``min_attempts`` (strict).
    """
    df = _resolved(events, seasons).where((F.col("type") == TYPE_POINT) | F.col("is_missed"))
    agg = df.groupBy(*KEYS).agg(
        _count_if(F.col("type") == TYPE_POINT).alias("_pl_point_events"),
        _count_if(F.col("is_made")).alias("makes"),
        _count_if(F.col("is_missed")).alias("misses"),
    )
    attempts = F.col("makes") + F.col("misses")
    return (agg.where((F.col("_pl_point_events") > 0) & (F.col("misses") > 0))
            .where(attempts > min_attempts)
            .select(*KEYS, "makes", "misses", attempts.alias("attempts"),
                    (F.col("makes") / attempts).alias("ratio")))


def shooting_ratio_by_join(makes: DataFrame, misses: DataFrame, min_attempts: int = 300) -> DataFrame:
    """JN-1 in its join form: inner join of per-(player, season) makes and
    misses tables (as :func:`makes_by_player_season` / :func:`misses_by_player_season`
    return them), ratio, strict attempts threshold. Same rows as
    :func:`shooting_ratio`, which needs one aggregation instead of two."""
    j = makes.join(misses, list(KEYS), "inner")
    attempts = F.col("makes") + F.col("misses")
    return j.where(attempts > min_attempts).select(*KEYS, "makes", "misses", attempts.alias("attempts"),
                                                   (F.col("makes") / attempts).alias("ratio"))


def player_season_metrics(events: DataFrame, seasons: Sequence[str] | None = None,
                          by_quarter: bool = False) -> DataFrame:
    """All per-(player, season) counts in one scan and one shuffle; with
    ``by_quarter`` a row for each quarter (NULL: unparsable clock).

    When several reports run together, compute this once (one row per
    player-season, small) and derive each report from it with
    :func:`metric_view`, instead of scanning the events once per report."""
    is_point = F.col("type") == TYPE_POINT
    keys = [*KEYS, "quarter"] if by_quarter else KEYS
    return _resolved(events, seasons).groupBy(*keys).agg(
        F.sum(F.when(is_point, F.col("points"))).cast("long").alias("points"),
        _count_if(is_point).alias("point_events"),
        _count_if(F.col("is_made")).alias("makes"),
        _count_if(F.col("is_missed")).alias("misses"),
        _count_if(F.col("is_foul")).alias("fouls"),
        F.sum(F.when(F.col("is_buzzer"), F.col("buzzer_value"))).cast("long").alias("buzzer_baskets"),
        _count_if(F.col("is_buzzer")).alias("buzzer_events"),
    )


def over_quarters(metrics: DataFrame) -> DataFrame:
    """:func:`player_season_metrics` by quarter, summed to one row per (player, season)."""
    names = [c for c in metrics.columns if c not in (*KEYS, "quarter")]
    return metrics.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in names])


def metric_view(metrics: DataFrame, kind: str, min_attempts: int = 300) -> DataFrame:
    """The per-(player, season) table of one metric, from :func:`player_season_metrics`.

    ``kind``: ``points`` / ``makes`` (player-seasons with a point event),
    ``misses``, ``fouls``, ``baskets`` (buzzer events) or ``ratio`` -- the same
    rows as :func:`points_by_player_season`, :func:`makes_by_player_season`,
    :func:`misses_by_player_season`, :func:`fouls_by_player_season`,
    :func:`buzzer_by_player_season` and :func:`shooting_ratio`.
    """
    m = metrics
    if kind == "points":
        return m.where(F.col("point_events") > 0).select(*KEYS, "points")
    if kind == "quarter_points":
        return m.where((F.col("point_events") > 0) & F.col("quarter").isNotNull()).select("quarter", *KEYS, "points")
    if kind == "makes":
        return m.where(F.col("point_events") > 0).select(*KEYS, "makes")
    if kind == "misses":
        return m.where(F.col("misses") > 0).select(*KEYS, "misses")
    if kind == "fouls":
        return m.where(F.col("fouls") > 0).select(*KEYS, "fouls")
    if kind == "baskets":
        return m.where(F.col("buzzer_events") > 0).select(*KEYS, F.col("buzzer_baskets").alias("baskets"))
    if kind == "ratio":
        attempts = F.col("makes") + F.col("misses")
        return (m.where((F.col("point_events") > 0) & (F.col("misses") > 0) & (attempts > min_attempts))
                .select(*KEYS, "makes", "misses", attempts.alias("attempts"),
                        (F.col("makes") / attempts).alias("ratio")))
    raise ValueError(f"unknown metric {kind!r}")
