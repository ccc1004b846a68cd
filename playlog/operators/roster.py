"""Roster lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.functions import scalars as S
from playlog.operators.joins import lookup_join, salted_lookup_join


def reduce_roster(roster: DataFrame) -> DataFrame:
    """One row per (name, team); the last row in file order wins (JN-4)."""
    return roster.groupBy("name", "team").agg(F.max_by("true_name", "ord").alias("true_name"))


def resolve_players(events: DataFrame, roster: DataFrame, include_unresolved: bool = False,
                    salt_hot: bool = False) -> DataFrame:
    """JN-4: add ``player`` by (name_token, team); unresolved -> NULL.

    An empty true name counts as unresolved. ``include_unresolved=True``
    keeps unresolved events as player ``''`` (the source's blank bucket).
    ``salt_hot=True`` finds names that hold a large share of the events by a
    sketch (one pass) and deals them over salts, for plans without AQE.
    """
    lookup = reduce_roster(roster).select(
        F.col("name").alias("name_token"), "team", F.col("true_name").alias("_pl_true_name"))
    join = salted_lookup_join if salt_hot else lookup_join
    joined = join(events, lookup, ["name_token", "team"])
    player = F.nullif(F.col("_pl_true_name"), F.lit(""))
    if include_unresolved:
        player = F.coalesce(player, F.lit(""))
    return joined.withColumn("player", player).drop("_pl_true_name")


def resolution_status(events: DataFrame) -> DataFrame:
    """Per-event status after :func:`resolve_players`: resolved, unresolved, no_token."""
    return events.select(
        "*",
        F.when(F.col("name_token").isNull(), F.lit("no_token"))
        .when(F.col("player").isNull() | (F.col("player") == ""), F.lit("unresolved"))
        .otherwise(F.lit("resolved")).alias("resolution"),
    )


def rewrite_log_names(parsed: DataFrame, roster: DataFrame, literal_token: bool = False,
                      salt_hot: bool = False) -> DataFrame:
    """Q-10 / JN-5 / FN-9: replace the short name in each line by the full name.

    ``parsed`` is :func:`parse_log` output. Every roster match gives one output
    line (duplicate roster rows duplicate the line); lines without a match pass
    through unchanged. The full name is written without its first space.

    Default: the text as written (``'O. Brien'``) is replaced, searching only
    after the ``'] '`` prefix. ``literal_token=True`` reproduces the source:
    the glued token (``'O.Brien'``) is searched in the whole line, so dotted
    names stay unchanged (but still count as rewritten). ``salt_hot``: as in
    :func:`resolve_players`.

    Columns: value (the output line), status (rewritten, unmatched, no_token,
    malformed), team.
    """
    lookup = roster.select(F.col("name").alias("name_token"), "team", F.col("true_name").alias("_pl_true_name"))
    join = salted_lookup_join if salt_hot else lookup_join
    joined = join(parsed.select("value", "entry", "team", "name_token", "name_text"), lookup, ["name_token", "team"])
    new_name = S.remove_first_space(F.col("_pl_true_name"))
    if literal_token:
        rewritten = S.replace_first(F.col("value"), F.col("name_token"), new_name)
    else:
        start = F.call_function("locate", F.lit(S.PREFIX_END), F.col("value")) + F.lit(len(S.PREFIX_END))
        rewritten = S.replace_first(F.col("value"), F.col("name_text"), new_name, start)
    status = (
        F.when(F.col("entry").isNull(), F.lit("malformed"))
        .when(F.col("name_token").isNull(), F.lit("no_token"))
        .when(F.col("_pl_true_name").isNull(), F.lit("unmatched"))
        .otherwise(F.lit("rewritten"))
    )
    return joined.select(
        F.when(status == "rewritten", rewritten).otherwise(F.col("value")).alias("value"),
        status.alias("status"),
        "team",
    )


def rewrite_audit(rewritten: DataFrame) -> DataFrame:
    """AGG-11: lines per status (the source's written / error counters)."""
    return rewritten.groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n"))


def _normalized(c) -> F.Column:
    return F.lower(F.regexp_replace(c, r"[^A-Za-z0-9]", ""))


def roster_coverage(events: DataFrame, roster: DataFrame, fallback: bool = False) -> DataFrame:
    """Q-11 / JN-6: which (team, name_token) pairs resolve, with event counts.

    Events are aggregated to distinct pairs first, so the join input is one
    row per pair. ``fallback=True`` adds a second, regex-normalised match
    (letters and digits only, case-folded) for pairs the exact key misses, as
    a column ``fallback_name``.
    """
    pairs = (events.where(F.col("name_token").isNotNull())
             .groupBy("team", "name_token").agg(F.count(F.lit(1)).cast("long").alias("n")))
    exact = reduce_roster(roster).select(F.col("name").alias("name_token"), "team", F.lit(True).alias("_pl_hit"))
    out = pairs.join(exact, ["name_token", "team"], "left").select(
        "team", "name_token", F.coalesce(F.col("_pl_hit"), F.lit(False)).alias("matched"), "n")
    if fallback:
        norm = (roster.select(_normalized(F.col("name")).alias("_pl_norm"), "team", "true_name", "ord")
                .groupBy("_pl_norm", "team").agg(F.max_by("true_name", "ord").alias("fallback_name")))
        out = (out.withColumn("_pl_norm", _normalized(F.col("name_token")))
               .join(norm, ["_pl_norm", "team"], "left")
               .select("team", "name_token", "matched",
                       F.when(~F.col("matched"), F.col("fallback_name")).alias("fallback_name"), "n"))
    return out
