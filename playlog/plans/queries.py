"""The user-level questions as DataFrame plans.

Each takes parsed, player-resolved events (:func:`load_events`) and returns a
DataFrame; nothing is collected. Defaults are the clean semantics of SURVEY
§2.12; parameters reproduce the source where it differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlog.functions import scalars as S
from playlog.operators import metrics as M
from playlog.operators import ranking as R
from playlog.operators import trends as T
from playlog.operators.matches import assign_match_ids, build_matches, running_score
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players, rewrite_log_names, roster_coverage
from playlog.operators.segments import ROW, SPLIT, build_marked_matches, marked_scores, segment_matches
from playlog.operators.sequence import number_rows
from playlog.sources.io import format_rows

# Six seasons the source restricts some reports to (FLT-9), and the
# offset of the later season's match numbering (SET-3).
SOURCE_SEASONS = ("2006/2007", "2007/2008", "2008/2009", "2009/2010", "2010/2011", "2011/2012")
LATER_LOAD_ID_OFFSET = 6545


def load_events(raw_log: DataFrame, roster: DataFrame, include_unresolved: bool = False) -> DataFrame:
    """Raw lines + roster -> typed events with ``player``."""
    return resolve_players(parse_log(raw_log), roster, include_unresolved=include_unresolved)


# --- Q-1 .. Q-8 -----------------------------------------------------------------

def top_scorers(events: DataFrame, n: int = 11, ties: str = "first") -> DataFrame:
    """Q-1: best player-seasons by points; the source prints 11 rows.

    ``ties='collapse'`` keeps one player-season per distinct total (the
    smallest player, season), as the source's value-keyed map does."""
    pts = M.points_by_player_season(events)
    top = R.top_n(pts, "points", n, None, ties, tiebreak=["player", "season_start"])
    return top.select("rank", "player", "season", "points")


def season_top_scorer(events: DataFrame, ties: str = "all", collapse_by=None) -> DataFrame:
    """Q-2: top scorer(s) of each season."""
    pts = M.points_by_player_season(events)
    return R.leader_per(pts, "points", "season", ties, tiebreak=["player"], collapse_by=collapse_by).select(
        "season", "player", "points")


def shooting_ratio_leaders(events: DataFrame, n: int = 3, min_attempts: int = 300,
                           seasons: Sequence[str] | None = None, ties: str = "first",
                           collapse_by=()) -> DataFrame:
    """Q-3: top ``n`` shooting ratio per season among player-seasons with more
    than ``min_attempts`` attempts. ``seasons=SOURCE_SEASONS`` reproduces the
    source's season filter; ``ties='collapse'`` keeps one player-season per
    ratio inside ``collapse_by`` (over all seasons by default, before the filter)."""
    ratio, ties = _scoped(M.shooting_ratio(events, min_attempts, None if ties == "collapse" else seasons), "ratio",
                          ties, collapse_by, ["player", "season_start"], seasons)
    top = R.top_n(ratio, "ratio", n, "season", ties, tiebreak=["player"])
    return top.select("season", "rank", "player", "makes", "misses", "ratio")


def season_top_fouler(events: DataFrame, ties: str = "all", collapse_by=None) -> DataFrame:
    """Q-4: most personal fouls in each season."""
    fouls = M.fouls_by_player_season(events)
    return R.leader_per(fouls, "fouls", "season", ties, tiebreak=["player"], collapse_by=collapse_by).select(
        "season", "player", "fouls")


def point_trend(events: DataFrame, seasons: Sequence[str] | None = None, ties: str = "all") -> DataFrame:
    """Q-5: change in points between consecutive seasons of a player, with the
    printable text; sort with :func:`playlog.operators.ranking.sort_desc` or
    number with :func:`ranked_trend`.

    ``ties='collapse'`` is the source's pair of value-keyed maps: one
    player-season per total over all seasons (before the season filter), then
    one pair per difference."""
    pts, ties = _scoped(M.points_by_player_season(events, None if ties == "collapse" else seasons), "points",
                        ties, (), ["player", "season_start"], seasons)
    pairs = T.consecutive_diff(pts, "player", "season_start", "points", label="season")
    if ties == "first":
        pairs = R.collapse_ties(pairs, "diff", None, ["player", "season_from"])
    return pairs.select("player", "season_from", "season_to", "points_from", "points_to", "diff",
                        S.trend_text("diff", "player", "season_from", "season_to").alias("trend"))


def ranked_trend(trend: DataFrame) -> DataFrame:
    """SRT-4: every difference numbered, largest first (ties by player, season),
    without one task over all pairs."""
    return number_rows(trend, [], [F.desc("diff"), F.col("player"), F.col("season_from")], "rank")


def _scoped(df: DataFrame, value: str, ties: str, scope, tiebreak: list[str],
            seasons: Sequence[str] | None) -> tuple[DataFrame, str]:
    """For ``ties='collapse'``: one row per value inside ``scope`` over all
    seasons, then the season filter; the tie rule left for the ranking."""
    if ties != "collapse":
        return df, ties
    return M.season_filter(R.collapse_ties(df, value, scope, tiebreak), seasons), "first"


def buzzer_beaters(events: DataFrame, n: int = 3, ties: str = "first", seasons: Sequence[str] | None = None,
                   include_overtime: bool = True) -> DataFrame:
    """Q-6 (WIN-2): top ``n`` per season by baskets in the last 12 seconds."""
    b = M.buzzer_by_player_season(events, seasons, include_overtime)
    top = R.top_n(b, "baskets", n, "season", ties, tiebreak=["player"])
    return top.select("season", "rank", "player", "baskets")


def quarter_point_leaders(events: DataFrame, n: int = 3, ties: str = "first",
                          seasons: Sequence[str] | None = None, collapse_by=None) -> DataFrame:
    """Q-7: top ``n`` (player, season) per quarter across seasons;
    :func:`listing` orders them 1ST..OT. With ``ties='collapse'`` equal totals
    collapse over all seasons before ``seasons`` filters, as in the source."""
    q, left = _scoped(M.quarter_points(events, None if ties == "collapse" else seasons), "points", ties,
                      ["quarter"] if collapse_by is None else collapse_by, ["player", "season_start", "quarter"], seasons)
    top = R.top_n(q, "points", n, "quarter", left, tiebreak=["player", "season_start"])
    return top.select("quarter", "rank", "player", "season", "points")


def ratio_trend(events: DataFrame, min_attempts: int = 300, seasons: Sequence[str] | None = None,
                ties: str = "all", collapse_by=()) -> DataFrame:
    """Q-8 pairs: ratio change between consecutive qualifying seasons.
    ``ties='collapse'`` keeps one player-season per ratio inside ``collapse_by``
    (over all seasons by default, before the season filter)."""
    ratio, _ = _scoped(M.shooting_ratio(events, min_attempts, None if ties == "collapse" else seasons), "ratio",
                       ties, collapse_by, ["player", "season_start"], seasons)
    pairs = T.consecutive_diff(ratio, "player", "season_start", "ratio", label="season")
    return pairs.select("player", "season_from", "season_to", "ratio_from", "ratio_to", "diff")


def ratio_trend_chain(events: DataFrame, min_attempts: int = 300, seasons: Sequence[str] | None = None) -> DataFrame:
    """Q-8 chain: per player, (season, ratio) for every season in a pair, in
    season order, each season once."""
    ratio = M.shooting_ratio(events, min_attempts, seasons).select("player", "season_start", "ratio")
    rows = T.periods_with_neighbour(ratio, "player", "season_start")
    return T.chain(rows, "player", "season_start", "ratio")


def listing(df: DataFrame, by: str, *rest: str, template: str, cols: Sequence[str]) -> DataFrame:
    """SET-1 / SET-2 / SNK-4: a report's rows as numbered printable lines, quarters
    in playing order (1ST..OT) or seasons in time order, then ``rest``. For
    reports of a bounded size (the top rows of each group)."""
    first = S.quarter_ordinal(by) if by == "quarter" else F.col(by)
    numbered = df.withColumn("line_no", F.row_number().over(Window.orderBy(first, *rest)).cast("long"))
    return format_rows(numbered, template, *cols).select("line_no", "line")


def season_reports(metrics: DataFrame, min_attempts: int = 300, n_top: int = 11, n_per_season: int = 3,
                   seasons: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Q-1..Q-8 from one :func:`playlog.operators.metrics.player_season_metrics`
    table -- the way to run the reports together with a single scan of the events.
    Q-7 needs the table by quarter (``by_quarter=True``), from which the others are summed.

    ``seasons`` restricts the reports the source restricts (ratio leaders,
    point trend, buzzer beaters, ratio trend); top scorers, season top scorer
    and season top fouler cover every season, as in the source."""
    quarters = None
    if "quarter" in metrics.columns:
        quarters, metrics = M.metric_view(metrics, "quarter_points"), M.over_quarters(metrics)
    m = M.season_filter(metrics, seasons)
    pts_all = M.metric_view(metrics, "points")
    pts = M.metric_view(m, "points")
    ratio = M.metric_view(m, "ratio", min_attempts)
    fouls = M.metric_view(metrics, "fouls")
    baskets = M.metric_view(m, "baskets")
    by_quarter = {} if quarters is None else {
        "quarter_point_leaders": R.top_n(M.season_filter(quarters, seasons), "points", n_per_season, "quarter", "first",
                                         ["player", "season_start"]).select("quarter", "rank", "player", "season", "points")}
    return {
        "top_scorers": R.top_overall(pts_all, "points", n_top, ["player", "season_start"]).select(
            "rank", "player", "season", "points"),
        "season_top_scorer": R.leader_per(pts_all, "points", "season", "all", ["player"]).select(
            "season", "player", "points"),
        "shooting_ratio_leaders": R.top_n(ratio, "ratio", n_per_season, "season", "first", ["player"]).select(
            "season", "rank", "player", "makes", "misses", "ratio"),
        "season_top_fouler": R.leader_per(fouls, "fouls", "season", "all", ["player"]).select(
            "season", "player", "fouls"),
        "point_trend": T.consecutive_diff(pts, "player", "season_start", "points", label="season").select(
            "player", "season_from", "season_to", "points_from", "points_to", "diff",
            S.trend_text("diff", "player", "season_from", "season_to").alias("trend")),
        "buzzer_beaters": R.top_n(baskets, "baskets", n_per_season, "season", "first", ["player"]).select(
            "season", "rank", "player", "baskets"),
        "ratio_trend": T.consecutive_diff(ratio, "player", "season_start", "ratio", label="season").select(
            "player", "season_from", "season_to", "ratio_from", "ratio_to", "diff"),
        **by_quarter,
    }


# --- Q-9 .. Q-12 --------------------------------------------------------------

def match_documents(raw_log: DataFrame, roster: DataFrame, max_events: int, id_offset: int = 0) -> DataFrame:
    """Q-9: raw ordered log + roster -> nested match documents, one for each
    match and part of ``max_events`` lines."""
    events = running_score(load_events(raw_log, roster))
    ids = assign_match_ids(events, id_offset)
    return build_matches(events, ids, max_events)


def marked_match_documents(ordered_log: DataFrame, roster: DataFrame, max_events: int, id_offset: int = 0,
                           carry_scores: bool = False) -> DataFrame:
    """Q-9 as the loaders cut the log: a match from each line 1 to the next, in the
    physical order of ``io.read_ordered_log``; scores run on over matches where asked."""
    events = resolve_players(parse_log(ordered_log, keep=(SPLIT, ROW)), roster)
    return build_marked_matches(marked_scores(segment_matches(events), carry_scores), max_events, id_offset)


def rewrite_names(raw_log: DataFrame, roster: DataFrame, literal_token: bool = False) -> DataFrame:
    """Q-10: log lines with true names."""
    return rewrite_log_names(parse_log(raw_log), roster, literal_token)


def coverage(raw_log: DataFrame, roster: DataFrame, fallback: bool = False) -> DataFrame:
    """Q-11: roster coverage of the (team, token) pairs in a log."""
    return roster_coverage(parse_log(raw_log), roster, fallback)


def count_lines_containing(lines: DataFrame, needles: Sequence[str], col: str = "value") -> DataFrame:
    """Q-12 (SRC-4, FLT-10, AGG-9): how many lines contain each needle -- one
    scan, one conditional count per needle, unpivoted to (needle, n)."""
    counts = lines.agg(*[F.count_if(S.contains_text(F.col(col), nd)).cast("long").alias(f"n{i}")
                         for i, nd in enumerate(needles)])
    stack = F.stack(F.lit(len(needles)), *[x for i, nd in enumerate(needles) for x in (F.lit(nd), F.col(f"n{i}"))])
    return counts.select(stack.alias("needle", "n"))


def generic_top_n(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """``top_n`` on a table that is not a play log: best customers per season
    by total order price."""
    from playlog.session import table_path

    o = spark.read.parquet(table_path(sf_dir, "orders")).select("o_custkey", "o_orderdate", "o_totalprice")
    start = S.season_start(F.date_format("o_orderdate", "yyyyMMdd"))
    per = (o.select("o_custkey", start.alias("season_start"), "o_totalprice")
           # decimals add up to the same total in any order
           .groupBy("season_start", "o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")))
    per = per.withColumn("season", S.season_label(F.col("season_start")))
    top = R.top_n(per, "total", n, "season", "first", tiebreak=["o_custkey"])
    return top.select("season", "rank", F.col("o_custkey").alias("custkey"), F.col("total").cast("double").alias("total"))
