"""Logs appended to a stored event table load by load, with report state that
follows (SURVEY SET-3, SNK-1, AGG-2..AGG-7).

A load brings its events and, from the same pass over them, its partial counts
for each (player, season, quarter). Counts add up, so the reports after an
append read the loads' partial counts and never the events of earlier loads. A
season that is delivered again replaces its load, and with it its counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.functions import scalars as S
from playlog.operators import metrics as M
from playlog.operators.ingest import (
    ORDERED_COLUMNS, PLACES, by_season, resolved_lines, scored_lines, typed_lines)
from playlog.operators.matches import assign_match_ids
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players
from playlog.operators.segments import marked_scores, segment_matches
from playlog.session import drop_path, scratch_path
from playlog.sources import loads as L

EVENTS, METRICS = "events", "metrics"


def _t(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
EVENT_SCHEMA = _t(
    id_match=_L, game_id=_S, date=_S, home=_S, away=_S, line_no=_I, time_remaining=_S, minute=_I, second=_I, is_ot=_B,
    quarter=_S, entry=_S, type=_S, team=_S, name_token=_S, name_text=_S, score_home_token=_I, score_away_token=_I,
    season=_S, points=_I, is_made=_B, is_missed=_B, is_foul=_B, is_buzzer=_B, buzzer_value=_I, status=_S, player=_S,
    score_home=_I, score_away=_I, season_start=_I)
METRIC_SCHEMA = _t(
    player=_S, season=_S, quarter=_S, points=_L, point_events=_L, makes=_L, misses=_L, fouls=_L, buzzer_baskets=_L,
    buzzer_events=_L, season_start=_I)


def _by_game(raw: DataFrame, roster: DataFrame, aside: str) -> DataFrame:
    """Events with scores and ids, matches told apart by game id. The resolved
    lines are written to ``aside`` for the scores and the ids, so the raw log is
    read once; the lines move, and become events where they are written."""
    resolved_lines(raw, roster, keep=PLACES).write.parquet(aside)
    lines = raw.sparkSession.read.parquet(aside)
    game = F.col("game_id")
    games = lines.select("game_id").distinct().select(
        "game_id", S.game_date_text(game).alias("date"), S.game_home(game).alias("home"), S.game_away(game).alias("away"))
    numbered = scored_lines(lines).join(assign_match_ids(games).select("game_id", "id_match"), "game_id")
    return typed_lines(by_season(numbered), ["id_match", *ORDERED_COLUMNS])


def _by_mark(raw: DataFrame, roster: DataFrame) -> DataFrame:
    """Events with scores and ids, matches told apart by their start marks."""
    parsed = parse_log(raw, keep=("log_split", "log_row"))
    scored = marked_scores(segment_matches(resolve_players(parsed, roster)))
    return scored.filter("match_seq > 0").withColumn("id_match", F.col("match_seq")).hint("rebalance", "season_start")


def append_log(spark: SparkSession, table: str, name: str, raw: DataFrame, roster: DataFrame,
               replacing: bool = False) -> L.Load:
    """Append a log to a table of loads, under a name that tells a repeat.

    ``raw`` is a log as ``io.read_play_log`` gives it (matches by game id) or
    ``io.read_ordered_log`` (matches by start marks). The counts and the largest
    id are read back from the events that were written.
    """
    def build(key: str) -> int:
        aside = scratch_path(spark, "load")
        by_mark = "log_split" in raw.columns
        rows = _by_mark(raw, roster) if by_mark else _by_game(raw, roster, aside)
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])
        events = spark.read.schema(EVENT_SCHEMA).parquet(L.write_part(typed, table, EVENTS, key, ("season_start",)))
        if not by_mark:
            drop_path(spark, aside)
        counts = M.player_season_metrics(events, by_quarter=True)
        L.write_part(counts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METRIC_SCHEMA.fields]), table,
                     METRICS, key, ("season_start",))
        return events.agg(F.coalesce(F.max("id_match"), F.lit(0))).first()[0]

    return L.append_load(spark, table, name, L.content_fingerprint(raw.select("value")), build, replacing)


def read_events(spark: SparkSession, table: str, version: int | None = None, names: Sequence[str] | None = None
                ) -> DataFrame:
    """Events of the published loads; ``id_match`` counts over all of them."""
    return L.read_part(spark, table, EVENTS, EVENT_SCHEMA, version, "id_match", list(names) if names else None)


def report_counts(spark: SparkSession, table: str, seasons: Sequence[str] | None = None, by_quarter: bool = False,
                  version: int | None = None) -> DataFrame:
    """``metrics.player_season_metrics`` of the whole table, from the loads' partial
    counts; every report follows by ``metrics.metric_view``."""
    partial = M.season_filter(L.read_part(spark, table, METRICS, METRIC_SCHEMA, version), seasons).drop("load")
    names = [f.name for f in METRIC_SCHEMA.fields if f.name not in (*M.KEYS, "quarter")]
    keys = [*M.KEYS, "quarter"] if by_quarter else list(M.KEYS)
    return partial.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in names])
