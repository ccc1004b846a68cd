"""Ingest: raw log + roster -> typed event table, written once.

The reports read a stored table, as the source's jobs read a stored document
collection. Parsing and the roster join run once per load; the reports then
get Parquet column pruning, pushed-down filters (``type``, ``player``,
``is_foul`` ...) and season partition pruning, instead of re-parsing text
for every question.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.operators.matches import running_score
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players
from playlog.session import drop_path, scratch_path
from playlog.sources import io

# Columns of the stored event table (season_start is the partition column).
EVENT_COLUMNS = (
    "game_id", "date", "home", "away", "line_no", "time_remaining", "minute", "second", "is_ot", "quarter",
    "entry", "type", "team", "name_token", "name_text", "score_home_token", "score_away_token",
    "season", "points", "is_made", "is_missed", "is_foul", "is_buzzer", "buzzer_value", "status", "player",
    "season_start",
)
ORDERED_COLUMNS = EVENT_COLUMNS + ("score_home", "score_away")


# Parsed columns that running scores are made from.
PLACES = ("game_id", "line_no", "score_home_token", "score_away_token")


def resolved_lines(raw_log: DataFrame, roster: DataFrame, include_unresolved: bool = False,
                   keep: Sequence[str] = ()) -> DataFrame:
    """The log's lines with ``player``, ``season_start`` and the parsed columns named in ``keep``.

    All other columns follow from the line, which is several times smaller than
    they are together. So the lines are what joins and shuffles move, and
    :func:`typed_lines` parses them in the task that writes them. The roster
    join moves its keys with them and nothing else: the columns in ``keep``
    are parsed behind it."""
    lines = parse_log(raw_log).select("value", "name_token", "team")
    resolved = resolve_players(lines, roster, include_unresolved=include_unresolved).select("value", "player")
    return typed_lines(resolved, ("value", "player", "season_start", *keep))


def scored_lines(lines: DataFrame) -> DataFrame:
    """:func:`resolved_lines` (with ``PLACES``), with running scores instead of score tokens."""
    return running_score(lines).drop("score_home_token", "score_away_token")


def by_season(lines: DataFrame) -> DataFrame:
    """Lines dealt by season (AQE splits a large one) and sorted by it, so that a
    table with a folder per season needs no sort of whole events."""
    return lines.hint("rebalance", "season_start").sortWithinPartitions("season_start")


def typed_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named event columns: those that ``lines`` holds, and the others parsed from the line."""
    held = {c: f"_pl_held_{c}" for c in lines.columns if c != "value"}
    parsed = parse_log(lines.withColumnsRenamed(held), keep=list(held.values()))
    return parsed.select(*[F.col(held[c]).alias(c) if c in held else F.col(c) for c in columns])


def events_table(raw_log: DataFrame, roster: DataFrame, include_unresolved: bool = False,
                 with_scores: bool = False) -> DataFrame:
    """Parsed, player-resolved events; ``with_scores`` adds running scores
    (needs unique line numbers per game)."""
    if with_scores:
        lines = scored_lines(resolved_lines(raw_log, roster, include_unresolved, PLACES))
        return typed_lines(lines, ORDERED_COLUMNS)
    return typed_lines(resolved_lines(raw_log, roster, include_unresolved), EVENT_COLUMNS)


def write_events_table(events: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False) -> None:
    """Parquet, one folder per season: season filters prune whole folders."""
    io.write_events(events, path, mode, rebalance)


def read_events_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ingest(raw_log: DataFrame, roster: DataFrame, path: str, include_unresolved: bool = False,
           with_scores: bool = False, mode: str = "overwrite", rebalance: bool = False) -> DataFrame:
    """Build, write and re-open the event table.

    Running scores need the lines twice (the lines and, for what earlier
    chunks carry forward, their ids and score tokens). The resolved lines are
    therefore written first and read back, so the raw log is read and resolved
    once."""
    spark = raw_log.sparkSession
    aside = scratch_path(spark, "resolved") if with_scores else None
    lines = resolved_lines(raw_log, roster, include_unresolved, PLACES if with_scores else ())
    if with_scores:
        lines.write.parquet(aside)
        lines = scored_lines(spark.read.parquet(aside)).drop("game_id", "line_no")  # the line tells them
    events = typed_lines(by_season(lines) if rebalance else lines, ORDERED_COLUMNS if with_scores else EVENT_COLUMNS)
    write_events_table(events, path, mode)
    if with_scores:
        drop_path(spark, aside)
    return read_events_table(spark, path)
