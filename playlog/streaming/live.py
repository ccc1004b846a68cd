"""Structured Streaming versions of the loader and the per-season totals.

The source's loaders read a log line by line as it arrives and keep the
current running score as state. Here:

* :func:`read_log_stream` -- new log files in a folder become a stream of lines;
* :func:`live_events` -- stateless parsing (the same column functions as batch)
  plus a stream-static roster join;
* :func:`live_running_score` -- per-game running score as custom state
  (``applyInPandasWithState``): the last home/away score of each game is
  kept between micro-batches, and dropped by an event-time timeout once
  the watermark passes the game's day (``game_close_delay``);
* :func:`live_points` -- per (player, season) points, updated every micro-batch;
* :func:`write_events_stream` -- append the parsed events to a season-partitioned
  Parquet table, with the checkpoint in the shared folder.

Lines of one game must arrive in line order across micro-batches (as a log
file is written); inside a micro-batch they are sorted by ``line_no``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from playlog.functions.scalars import TYPE_POINT
from playlog.operators.parse import parse_log
from playlog.operators.roster import reduce_roster, resolve_players
from playlog.session import ensure_checkpoint_dir


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as a stream of log lines (column ``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def static_roster(roster: DataFrame) -> DataFrame:
    """The roster as every micro-batch reads it: one row a (name, team), written once
    (the place of a line in a roster file can't be computed inside a stream)."""
    ensure_checkpoint_dir(roster.sparkSession)
    return reduce_roster(roster).withColumn("ord", F.lit(0)).checkpoint()


def live_events(lines: DataFrame, roster: DataFrame) -> DataFrame:
    """Parse streamed lines and resolve players against a static roster."""
    return resolve_players(parse_log(lines), static_roster(roster))


DAY_MS = 24 * 3600 * 1000


def live_running_score(events: DataFrame, game_close_delay: str | None = None) -> DataFrame:
    """Running score per game across micro-batches (WIN-5 as streaming state).

    State per game: (score_home, score_away) after its last processed line.
    Output: game_id, line_no, score_home, score_away for every event.

    ``game_close_delay`` (e.g. ``"1 day"``) bounds the state: the game date is
    the event time, the watermark trails the newest game date by the delay,
    and a game's state is dropped once the watermark passes the end of its
    day (event-time timeout). Without it the state keeps one row per game seen.
    """
    out_schema = T.StructType([
        T.StructField("game_id", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("score_home", T.IntegerType()),
        T.StructField("score_away", T.IntegerType()),
    ])
    state_schema = T.StructType([
        T.StructField("score_home", T.IntegerType()),
        T.StructField("score_away", T.IntegerType()),
    ])

    timed = game_close_delay is not None

    def step(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # the watermark passed the game's day: forget it
            state.remove()
            return
        home, away = state.get if state.exists else (0, 0)
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values("line_no", kind="stable")
        h = batch["score_home_token"].astype("Float64").ffill().fillna(home).astype("int32")
        a = batch["score_away_token"].astype("Float64").ffill().fillna(away).astype("int32")
        state.update((int(h.iloc[-1]), int(a.iloc[-1])))
        if timed:
            day_end = int(pd.Timestamp(batch["_pl_time"].max()).value // 1_000_000) + DAY_MS
            state.setTimeoutTimestamp(max(day_end, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"game_id": batch["game_id"].values, "line_no": batch["line_no"].astype("int32").values,
                            "score_home": h.values, "score_away": a.values})

    cols = events.select("game_id", "line_no", "score_home_token", "score_away_token",
                         F.col("game_date").cast("timestamp").alias("_pl_time"))
    timeout = GroupStateTimeout.NoTimeout
    if timed:
        cols = cols.withWatermark("_pl_time", game_close_delay)
        timeout = GroupStateTimeout.EventTimeTimeout
    return cols.groupBy("game_id").applyInPandasWithState(step, out_schema, state_schema, "append", timeout)


def live_points(events: DataFrame) -> DataFrame:
    """Points per (player, season), re-emitted as they change (output mode
    ``update``); the state holds one row per player-season."""
    return (events.where(F.col("player").isNotNull() & (F.col("type") == TYPE_POINT))
            .groupBy("player", "season").agg(F.sum("points").cast("long").alias("points")))


def write_events_stream(events: DataFrame, path: str, checkpoint: str, trigger_once: bool = False):
    """Append parsed events to a Parquet table partitioned by season."""
    w = (events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy("season_start").outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
