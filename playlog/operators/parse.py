"""Raw log lines -> typed event rows.

Staged projections: each split of the line, the clock and the event text is
computed once as a helper column and every derived column reads the helper.
Catalyst does not merge a stage into the next when that would repeat a
non-trivial expression, so the splits stay single. Unused columns are pruned
by Catalyst, so every query can start from :func:`parse_log`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.functions import scalars as S


def parse_log(raw: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Split ``game_id \\t line_no \\t clock \\t entry`` lines into event columns.

    Columns: value (the line), game_id, date, game_date, home, away, line_no,
    time_remaining, minute, second, is_ot, quarter, entry, type, team,
    name_token, name_text, score_home_token, score_away_token, season_start,
    season, points, is_made, is_missed, is_foul, is_buzzer, buzzer_value,
    status (``'malformed'`` when the line has fewer than 4 fields). Columns of
    ``raw`` named in ``keep`` (a line's place in its file) follow.
    """
    fields = raw.select(*keep, F.col(value_col).alias("value"), F.split(F.col(value_col), S.FIELD_SEP).alias("_pl_fields"))
    base = fields.select(
        *keep, "value",
        F.get("_pl_fields", 0).alias("game_id"),
        F.get("_pl_fields", 1).try_cast("int").alias("line_no"),
        F.get("_pl_fields", 2).alias("time_remaining"),
        F.get("_pl_fields", 3).alias("entry"),
    )
    has_prefix = F.contains(F.col("entry"), F.lit(S.PREFIX_END))
    helpers = base.select(
        "*",
        S.game_date_text("game_id").alias("date"),
        S.game_home("game_id").alias("home"),
        S.game_away("game_id").alias("away"),
        F.split(F.col("time_remaining"), ":").alias("_pl_clock"),
        S.bracket_head("entry").alias("_pl_head"),
        has_prefix.alias("_pl_has_prefix"),
        F.split_part(F.col("entry"), F.lit(S.PREFIX_END), F.lit(1)).alias("_pl_prefix"),
        F.when(has_prefix, F.split_part(F.col("entry"), F.lit(S.PREFIX_END), F.lit(2))).alias("_pl_rest"),
        F.contains(F.col("value"), F.lit("[")).alias("_pl_bracket"),
    )
    words = helpers.select(
        "*",
        F.split_part("_pl_rest", F.lit(" "), F.lit(1)).alias("_pl_w1"),
        F.split_part("_pl_rest", F.lit(" "), F.lit(2)).alias("_pl_w2"),
        F.get("_pl_clock", 1).try_cast("int").alias("minute"),
        F.get("_pl_clock", 2).try_cast("int").alias("second"),
        S.is_overtime("time_remaining").alias("is_ot"),
        S.event_type_from("_pl_bracket", "entry", "_pl_head").alias("type"),
        S.score_side_from("_pl_head").alias("_pl_side"),
        S.score_token_from("_pl_head").alias("_pl_score"),
        S.season_start("date").alias("season_start"),
    ).drop("_pl_rest")
    typed = F.col("type")
    out = words.select(
        "*",
        S.game_date("game_id").alias("game_date"),
        S.quarter_from("minute", "is_ot").alias("quarter"),
        F.when(F.col("_pl_has_prefix"), F.substring("_pl_prefix", 2, 3)).alias("team"),
        S.name_token_from("_pl_w1", "_pl_w2").alias("name_token"),
        S.name_text_from("_pl_w1", "_pl_w2").alias("name_text"),
        F.when(F.col("_pl_side") == F.col("home"), F.col("_pl_score")).alias("score_home_token"),
        F.when(F.col("_pl_side") == F.col("away"), F.col("_pl_score")).alias("score_away_token"),
        S.season_label("season_start").alias("season"),
        S.event_points(typed, "entry").alias("points"),
        S.is_made(typed, "entry").alias("is_made"),
        S.is_missed(typed, "entry").alias("is_missed"),
        S.is_foul("entry").alias("is_foul"),
        S.buzzer_time_from(typed, "minute", "second", "is_ot").alias("is_buzzer"),
        S.buzzer_value("entry").alias("buzzer_value"),
        F.when(F.col("entry").isNull(), F.lit("malformed")).otherwise(F.lit("ok")).alias("status"),
    )
    return out.select(
        "value", "game_id", "date", "game_date", "home", "away", "line_no", "time_remaining", "minute", "second",
        "is_ot", "quarter", "entry", "type", "team", "name_token", "name_text", "score_home_token",
        "score_away_token", "season_start", "season", "points", "is_made", "is_missed", "is_foul", "is_buzzer",
        "buzzer_value", "status", *keep,
    )
