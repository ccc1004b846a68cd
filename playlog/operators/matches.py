"""Match documents from an ordered log (SURVEY WIN-5, WIN-6, AGG-10, PRJ-1,
PRJ-2, FN-16, SET-3; Q-9).

Ordered per-game work is chunked by line number (:mod:`playlog.operators.sequence`),
so one very long game is spread over many tasks. The grain of the documents
is (id_match, part): the caller states how many lines a part covers, and a
game with more becomes parts 0, 1, ... instead of one unbounded row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog import schemas
from playlog.functions import scalars as S
from playlog.operators.sequence import prefix_within

DEFAULT_CHUNK_LINES = 4096


def running_score(events: DataFrame, chunk_lines: int = DEFAULT_CHUNK_LINES) -> DataFrame:
    """WIN-5: score_home / score_away = last score token seen for that side in
    the game up to and including the line; 0 before the first one.

    Scores restart with every game (the source carried them over; SURVEY Q6).
    ``line_no`` must be unique inside a game.
    """
    chunk = F.floor((F.col("line_no") - 1) / chunk_lines)
    filled = prefix_within(
        events, ["game_id"], ["line_no"], chunk,
        fills={"_pl_sh": F.col("score_home_token"), "_pl_sa": F.col("score_away_token")},
    )
    return filled.select(
        *[c for c in filled.columns if c not in ("_pl_sh", "_pl_sa")],
        F.coalesce(F.col("_pl_sh"), F.lit(0)).alias("score_home"),
        F.coalesce(F.col("_pl_sa"), F.lit(0)).alias("score_away"),
    )


def games(events: DataFrame) -> DataFrame:
    """One row per game: game_id, date, home, away."""
    return events.select("game_id", "date", "home", "away").dropDuplicates(["game_id"])


def assign_match_ids(events: DataFrame, offset: int = 0) -> DataFrame:
    """WIN-6: number games 1, 2, ... in (date, game_id) order, plus ``offset``.

    ``game_id`` starts with the date, so its order is (date, game_id). The
    numbering runs over the game table (one row per game), chunked by date:
    one task numbers the games of one date (bounded by the number of team
    pairs), and only the per-date counts are carried across dates, by one
    task over at most as many rows as the calendar has days. Games whose
    date is no calendar day form one chunk, numbered first.
    """
    g = games(events)
    day = F.when(S.game_date("game_id").isNotNull(), F.col("date"))
    numbered = prefix_within(g, [], ["game_id"], day, counter="_pl_seq")
    return numbered.select("game_id", "date", "home", "away",
                           (F.col("_pl_seq") + F.lit(offset)).cast("long").alias("id_match"))


def append_match_ids(earlier: DataFrame, later_events: DataFrame) -> DataFrame:
    """SET-3: number a later load after an earlier one (ids continue)."""
    base = earlier.agg(F.coalesce(F.max("id_match"), F.lit(0)).alias("_pl_base"))
    ids = assign_match_ids(later_events, 0)
    return ids.crossJoin(F.broadcast(base)).select(
        "game_id", "date", "home", "away", (F.col("id_match") + F.col("_pl_base")).alias("id_match"))


def build_matches(events: DataFrame, match_ids: DataFrame, max_events: int) -> DataFrame:
    """AGG-10: nested documents ``(id_match, game_id, part, date, home, away, report)``.

    One document for each game and part of ``max_events`` line numbers (a
    number above the longest game gives one document a match). ``events``
    needs line_no, type, time_remaining, entry, score_home, score_away and
    player. ``report`` is ordered by line number.

    The documents are grouped by (game, part), so a hot game spreads over its
    parts; the ids come as one small row for each (game, part) and join on the
    same keys, so the documents do not move again. A line without a game id
    or line number lands in a document of its own kind (NULL id or part).
    """
    part = F.floor((F.col("line_no") - 1) / max_events).cast("int")
    keys = ["_pl_gn", "_pl_g", "_pl_pn", "_pl_p"]
    ev = events.select(
        # NULL-free stand-ins: equal keys for the grouping and the join
        F.col("game_id").isNull().alias("_pl_gn"), F.coalesce("game_id", F.lit("")).alias("_pl_g"),
        part.isNull().alias("_pl_pn"), F.coalesce(part, F.lit(0)).alias("_pl_p"),
        F.struct(
            F.col("line_no").alias("_pl_line"),
            F.col("type"),
            F.col("home"),
            F.col("away"),
            F.col("time_remaining").alias("timeRemaining"),
            F.col("entry"),
            F.col("score_home").cast("int").alias("scoreHome"),
            F.col("score_away").cast("int").alias("scoreAway"),
            F.col("player").alias("playerName"),
        ).alias("_pl_ev"),
    )
    grouped = ev.groupBy(*keys).agg(F.sort_array(F.collect_list("_pl_ev")).alias("_pl_report"))
    fields = [f.name for f in schemas.REPORT_EVENT.fields]

    def event(x):
        # the line number moves once, as the number that the report is ordered by
        return F.struct(*[(x["_pl_line"].cast("string") if f == "idLineEvent" else x[f]).alias(f) for f in fields])

    report = F.transform(F.col("_pl_report"), event)
    ids = match_ids.select(F.col("game_id").isNull().alias("_pl_gn"), F.coalesce("game_id", F.lit("")).alias("_pl_g"),
                           "id_match", "date", "home", "away")
    parts = ev.select(*keys).distinct().join(ids, ["_pl_gn", "_pl_g"])
    return grouped.join(parts.hint("shuffle_hash"), keys).select(
        "id_match", F.when(~F.col("_pl_gn"), F.col("_pl_g")).alias("game_id"),
        F.when(~F.col("_pl_pn"), F.col("_pl_p")).alias("part"), "date", "home", "away", report.alias("report"))


def flatten_matches(docs: DataFrame) -> DataFrame:
    """PRJ-1: one row per event with the match fields as plain columns.

    ``explode(arrays_zip(report.a, report.b, ...))`` reads only the listed
    nested fields; a bare ``explode(report)`` would read every field.
    """
    fields = [f.name for f in schemas.REPORT_EVENT.fields]
    zipped = F.arrays_zip(*[F.col("report")[f].alias(f) for f in fields])
    ex = docs.select("id_match", "game_id", "part", "date", "home", "away", F.explode(zipped).alias("_pl_e"))
    return ex.select(
        "id_match", "game_id", "part", "date", "home", "away",
        *[F.col("_pl_e")[f].alias(f) for f in fields if f not in ("home", "away")],
    )


def events_from_documents(docs: DataFrame) -> DataFrame:
    """Stored match documents -> the event columns the reports use.

    Flattens ``report`` (reading only the needed fields) and derives season,
    points, made/missed/foul/buzzer flags and clock fields from the stored
    type, entry, clock and date -- so every report runs on a document
    collection as well as on the event table.
    """
    needed = ["type", "idLineEvent", "timeRemaining", "entry", "scoreHome", "scoreAway", "playerName"]
    zipped = F.arrays_zip(*[F.col("report")[f].alias(f) for f in needed])
    ex = docs.select("id_match", "game_id", "date", "home", "away", F.explode(zipped).alias("_pl_e"))
    e = ex.select("id_match", "game_id", "date", "home", "away",
                  *[F.col("_pl_e")[f].alias(f) for f in needed])
    start = S.season_start(F.col("date"))
    t = F.col("timeRemaining")
    return e.select(
        "id_match", "game_id", "date", "home", "away",
        F.col("idLineEvent").try_cast("int").alias("line_no"),
        t.alias("time_remaining"), "entry", "type",
        S.clock_minute(t).alias("minute"), S.clock_second(t).alias("second"),
        S.is_overtime(t).alias("is_ot"), S.quarter(t).alias("quarter"),
        start.alias("season_start"), S.season_label(start).alias("season"),
        S.event_points("type", "entry").alias("points"),
        S.is_made("type", "entry").alias("is_made"),
        S.is_missed("type", "entry").alias("is_missed"),
        S.is_foul("entry").alias("is_foul"),
        S.is_buzzer_time("type", t).alias("is_buzzer"),
        S.buzzer_value("entry").alias("buzzer_value"),
        F.col("scoreHome").alias("score_home"), F.col("scoreAway").alias("score_away"),
        F.nullif(F.col("playerName"), F.lit("")).alias("player"),
    )


def events_from_json(df: DataFrame, col: str = "value") -> DataFrame:
    """PRJ-2 / FN-16: event records that arrive as JSON text -> typed columns."""
    parsed = F.from_json(F.col(col), schemas.REPORT_EVENT)
    return df.select(*[c for c in df.columns if c != col], parsed.alias("_pl_e")).select(
        *[c for c in df.columns if c != col], "_pl_e.*")


def documents_as_json(docs: DataFrame) -> DataFrame:
    """FN-16 / SNK-2: one JSON text per document (column ``value``), for text sinks."""
    return docs.select(F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("value"))


def report_summary(docs: DataFrame) -> DataFrame:
    """FN-16: per document, events count and the last event's score."""
    last = F.element_at(F.col("report"), -1)
    return docs.select("id_match", "game_id", "part", F.size("report").alias("n_events"),
                       last["scoreHome"].alias("last_home"), last["scoreAway"].alias("last_away"))
