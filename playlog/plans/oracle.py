"""DuckDB SQL for each registered query, computed from the original columns.

The engine goes table -> log text -> parse -> join -> aggregate; these
statements go straight from the supplied columns (flag, line number,
quantity, discount, supplier name) to the answer, so a parsing mistake
cannot cancel out. Views ``lineitem orders supplier customer events
documents`` are registered by the caller.
"""

from __future__ import annotations

# Corpus A from the table columns (FIXTURES §3.1).
_A = """
a0 AS (
  SELECT
    strftime(o.o_orderdate, '%Y%m%d') AS date,
    'H' || lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS home,
    'A' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS away,
    l.l_linenumber AS line_no,
    CAST(l.l_quantity AS INTEGER) - 3 AS mi,
    CAST(round(l.l_discount * 100) AS INTEGER) * 5 AS se,
    l.l_suppkey AS suppkey,
    l.l_returnflag AS flag,
    l.l_linestatus AS status,
    s.s_name AS s_name,
    CASE WHEN month(o.o_orderdate) < 8 THEN year(o.o_orderdate) - 1 ELSE year(o.o_orderdate) END AS season_start
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
a AS (
  SELECT *,
    date || home || away AS game_id,
    CAST(season_start AS VARCHAR) || '/' || CAST(season_start + 1 AS VARCHAR) AS season,
    (flag = 'R' AND status = 'O' AND line_no % 2 = 1) AS no_token,
    CASE WHEN flag = 'R' AND status = 'O' AND line_no % 2 = 1 THEN 'gameDescription'
         WHEN flag = 'A' OR (flag = 'R' AND status = 'O') THEN 'point'
         ELSE 'generalEvent' END AS type,
    CASE WHEN flag = 'A' AND line_no <= 2 THEN 1 WHEN flag = 'A' AND line_no <= 4 THEN 3
         WHEN flag = 'A' THEN 2 ELSE 0 END AS points,
    flag = 'A' AS is_made,
    flag = 'N' AS is_missed,
    flag = 'R' AND status = 'F' AS is_foul,
    CASE WHEN mi < 0 THEN 'OT' WHEN mi < 12 THEN '4TH' WHEN mi < 24 THEN '3RD'
         WHEN mi < 36 THEN '2ND' ELSE '1ST' END AS quarter,
    CASE WHEN mi < 0 THEN -mi - 1 ELSE mi END AS minute,
    (flag = 'A' OR (flag = 'R' AND status = 'O' AND line_no % 2 = 0)) AND mi IN (0, -1) AND se <= 12 AS is_buzzer,
    CASE WHEN flag = 'A' AND line_no > 2 THEN 1 ELSE 0 END AS buzzer_value,
    CASE WHEN suppkey % 2 = 0 THEN 'J.S' ELSE 'S' END || CAST(suppkey AS VARCHAR) AS token,
    CASE WHEN suppkey % 2 = 0 THEN 'J. S' ELSE 'S' END || CAST(suppkey AS VARCHAR) AS token_text
  FROM a0
),
e AS (
  SELECT *,
    CASE WHEN no_token THEN NULL ELSE token END AS name_token,
    CASE WHEN no_token OR suppkey % 25 = 0 THEN NULL ELSE replace(s_name, '#', ', ') END AS player
  FROM a
)"""

# Corpus B from the events columns (FIXTURES §3.2).
_B = """
b0 AS (
  SELECT event_id, ts, user_id, event_type,
    strftime(ts, '%Y%m%d') || 'T' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0')
      || 'V' || lpad(CAST((user_id // 5) % 5 AS VARCHAR), 2, '0') AS game_id,
    event_id % 2 = 0 AS home_side,
    CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END AS pts
  FROM events
),
b AS (
  SELECT *,
    row_number() OVER (PARTITION BY game_id ORDER BY ts, event_id) AS line_no,
    sum(CASE WHEN home_side THEN pts ELSE 0 END) OVER (PARTITION BY game_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS score_home,
    sum(CASE WHEN home_side THEN 0 ELSE pts END) OVER (PARTITION BY game_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS score_away
  FROM b0
),
g AS (
  SELECT game_id, 6545 + row_number() OVER (ORDER BY game_id) AS id_match
  FROM (SELECT DISTINCT game_id FROM b0)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


_RATIO = """
r AS (
  SELECT player, season, season_start,
    count(*) FILTER (WHERE is_made) AS makes,
    count(*) FILTER (WHERE is_missed) AS misses,
    count(*) FILTER (WHERE type = 'point') AS point_events
  FROM e WHERE player IS NOT NULL AND (type = 'point' OR is_missed)
  GROUP BY player, season, season_start
),
q AS (
  SELECT player, season, season_start, makes, misses, makes + misses AS attempts,
    CAST(makes AS DOUBLE) / (makes + misses) AS ratio
  FROM r WHERE point_events > 0 AND misses > 0 AND makes + misses > 40
)"""

_POINTS = """
p AS (
  SELECT player, season, season_start, CAST(sum(points) AS BIGINT) AS points
  FROM e WHERE player IS NOT NULL AND type = 'point'
  GROUP BY player, season, season_start
)"""

_BUZZ = """
bz AS (
  SELECT player, season, CAST(sum(buzzer_value) AS BIGINT) AS baskets
  FROM e WHERE player IS NOT NULL AND is_buzzer
  GROUP BY player, season
)"""

# The supplier's full name.
_FULL = "replace(s_name, '#', ', ')"


def _lines(who: str) -> str:
    """CTE ``lt``: the log line built from the columns, with ``who`` as the name."""
    return f"""
ln AS (
  SELECT *,
    CASE WHEN mi < 0 THEN '-00:' || lpad(CAST(-mi - 1 AS VARCHAR), 2, '0')
         ELSE '00:' || lpad(CAST(mi AS VARCHAR), 2, '0') END || ':' || lpad(CAST(se AS VARCHAR), 2, '0') AS clock,
    CASE WHEN no_token THEN 'no_token' WHEN suppkey % 25 = 0 THEN 'unmatched' ELSE 'rewritten' END AS rstatus,
    {who} AS who
  FROM named
),
lt AS (
  SELECT *,
    game_id || chr(9) || CAST(line_no AS VARCHAR) || chr(9) || clock || chr(9) ||
    CASE
      WHEN flag = 'A' THEN '[' || home || ' 10-8] ' || who ||
        CASE WHEN line_no <= 2 THEN ' Free Throw 1 of 1 (1 PTS)' WHEN line_no <= 4 THEN ' 3pt Shot: Made (3 PTS)'
             ELSE ' Jump Shot: Made (2 PTS)' END
      WHEN flag = 'N' THEN '[' || home || '] ' || who ||
        CASE WHEN status = 'O' THEN ' Jump Shot: Missed' ELSE ' Free Throw 1 of 2 missed' END
      WHEN status = 'F' THEN '[' || home || '] ' || who || ' Foul: Shooting (1 PF)'
      WHEN line_no % 2 = 1 THEN 'Timeout: Regular'
      ELSE '[' || home || ' 10-8] ' || who || ' Goaltending'
    END AS line
  FROM ln
)"""


# One roster line for each player (clean), or a second one for every tenth (careless file).
_ONE_NAME = "named AS (SELECT *, '' AS suffix FROM a)"
_EVERY_NAME = """
named AS (
  SELECT *, '' AS suffix FROM a
  UNION ALL
  SELECT *, ' Jr' AS suffix FROM a WHERE NOT no_token AND suppkey % 10 = 0 AND suppkey % 25 <> 0
)"""
# The name in the line: blanks after the comma go; the literal search misses dotted names.
_REWRITTEN = ("CASE WHEN no_token OR suppkey % 25 = 0 THEN token_text ELSE replace(s_name, '#', ',') || suffix END")
_LITERAL = ("CASE WHEN no_token OR suppkey % 25 = 0 OR suppkey % 2 = 0 THEN token_text "
            "ELSE replace(s_name, '#', ',') END")

# One row per value over all seasons, the smallest player and season.
_ONE_RATIO = """
q1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ratio ORDER BY player, season_start) AS one FROM q) WHERE one = 1
)"""
_ONE_TOTAL = """
p1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY points ORDER BY player, season_start) AS one FROM p) WHERE one = 1
)"""
_SIX = "('1995/1996', '1996/1997', '1997/1998', '1998/1999', '1999/2000', '2000/2001')"


def _trend(table: str) -> str:
    return f"""
SELECT a.player, a.season AS season_from, b.season AS season_to, a.points AS points_from, b.points AS points_to,
  b.points - a.points AS diff,
  CAST(b.points - a.points AS VARCHAR) || ' ' || a.player || ' between ' || a.season || ' and ' || b.season AS trend
FROM {table} a JOIN {table} b ON a.player = b.player AND b.season_start = a.season_start + 1"""


def _ratio_trend(table: str) -> str:
    return f"""
SELECT a.player, a.season AS season_from, b.season AS season_to, a.ratio AS ratio_from, b.ratio AS ratio_to,
  b.ratio - a.ratio AS diff
FROM {table} a JOIN {table} b ON a.player = b.player AND b.season_start = a.season_start + 1"""


_QUARTER_POINTS = """
qp AS (
  SELECT quarter, player, season, season_start, CAST(sum(points) AS BIGINT) AS points
  FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY quarter, player, season, season_start
),
qp1 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY points ORDER BY player, season_start, quarter) AS one FROM qp
  ) WHERE one = 1
)"""


def _report_rows(size: int, lines: str = "b JOIN g ON b.game_id = g.game_id", ids: str = "g.id_match",
                 parts: tuple[str, ...] = (_B,)) -> str:
    """Corpus B's documents of ``size`` lines, event by event."""
    return _with(*parts) + f"""
SELECT {ids} AS id_match, b.game_id, CAST((b.line_no - 1) // {size} AS INTEGER) AS part,
  CAST((b.line_no - 1) % {size} + 1 AS BIGINT) AS pos,
  substr(b.game_id, 1, 8) AS date, substr(b.game_id, 9, 3) AS home, substr(b.game_id, 12, 3) AS away,
  CAST(b.line_no AS INTEGER) AS line_no,
  CASE WHEN b.pts > 0 THEN 'point' WHEN b.event_type = 'view' THEN 'generalEvent' ELSE 'gameDescription' END AS type,
  substr(b.game_id, 9, 3) AS event_home, substr(b.game_id, 12, 3) AS event_away,
  '00:' || lpad(CAST(b.event_id % 48 AS VARCHAR), 2, '0') || ':' || lpad(CAST(b.event_id % 60 AS VARCHAR), 2, '0')
    AS time_remaining,
  CASE WHEN b.pts > 0 THEN '[' || substr(b.game_id, CASE WHEN home_side THEN 9 ELSE 12 END, 3) || ' ' ||
         CAST(CASE WHEN home_side THEN score_home ELSE score_away END AS VARCHAR) || '-' ||
         CAST(CASE WHEN home_side THEN score_away ELSE score_home END AS VARCHAR) || '] U' || CAST(b.user_id AS VARCHAR) ||
         CASE b.pts WHEN 1 THEN ' Free Throw 1 of 1 (1 PTS)' WHEN 2 THEN ' Jump Shot: Made (2 PTS)'
                    ELSE ' 3pt Shot: Made (3 PTS)' END
       WHEN b.event_type = 'view' THEN '[' || substr(b.game_id, CASE WHEN home_side THEN 9 ELSE 12 END, 3) || '] U' ||
         CAST(b.user_id AS VARCHAR) || ' Jump Shot: Missed'
       ELSE 'Timeout: Regular' END AS entry,
  CAST(b.score_home AS INTEGER) AS score_home, CAST(b.score_away AS INTEGER) AS score_away,
  CASE WHEN b.pts > 0 OR b.event_type = 'view' THEN 'User, ' || CAST(b.user_id AS VARCHAR) END AS player
FROM {lines}"""


# The recorded log: all games in order, then those of one home team again.
_REC = """
rec AS (
  SELECT 0 AS copy, * FROM b UNION ALL SELECT 1 AS copy, * FROM b WHERE substr(game_id, 9, 3) = 'T00'
),
m AS (
  SELECT copy AS mcopy, game_id AS mgame, row_number() OVER (ORDER BY copy, game_id) AS seq
  FROM (SELECT DISTINCT copy, game_id FROM rec)
)"""
_REC_JOIN = "rec AS b JOIN m ON b.copy = m.mcopy AND b.game_id = m.mgame"


ORACLE: dict[str, str] = {
    "parse_game_id": _with(_A) + """
SELECT home, away, count(*) AS n_lines, count(DISTINCT game_id) AS n_games,
  CAST(sum(line_no) AS BIGINT) AS sum_line_no, min(date) AS first_date, max(date) AS last_date
FROM e GROUP BY home, away""",

    "classify_event": _with(_A) + "SELECT type, count(*) AS n FROM e GROUP BY type",

    "event_team_token": _with(_A) + """
SELECT home AS team, name_token, count(*) AS n FROM e WHERE name_token IS NOT NULL GROUP BY home, name_token""",

    "clock_and_quarter": _with(_A) + """
SELECT quarter, count(*) AS n, min(minute) AS min_minute, max(minute) AS max_minute,
  CAST(sum(se) AS BIGINT) AS sum_second
FROM e GROUP BY quarter""",

    "season_of": _with(_A) + """
SELECT season, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM e GROUP BY season""",

    "point_value": _with(_A) + "SELECT points AS value, count(*) AS n FROM e GROUP BY points",

    "resolve_players": _with(_A) + """
SELECT CASE WHEN name_token IS NULL THEN 'no_token' WHEN player IS NULL THEN 'unresolved' ELSE 'resolved' END AS status,
  count(*) AS n
FROM e GROUP BY 1""",

    "roster_coverage": _with(_A) + """
SELECT home AS team, name_token, suppkey % 25 <> 0 AS matched, count(*) AS n
FROM e WHERE name_token IS NOT NULL GROUP BY home, name_token, suppkey % 25 <> 0""",

    "resolve_players_last_wins": _with(_A) + f"""
SELECT home AS team, name_token,
  CASE WHEN suppkey % 25 = 0 THEN NULL WHEN suppkey % 10 = 0 THEN {_FULL} || ' Jr' ELSE {_FULL} END AS player,
  count(*) AS n
FROM e WHERE name_token IS NOT NULL GROUP BY 1, 2, 3""",

    "roster_coverage_fallback": _with(_A) + f"""
SELECT home AS team, name_token, suppkey % 25 <> 0 AS matched,
  CASE WHEN suppkey % 25 <> 0 THEN NULL WHEN suppkey % 10 = 0 THEN {_FULL} || ' Jr' ELSE {_FULL} END AS fallback_name,
  count(*) AS n
FROM e WHERE name_token IS NOT NULL GROUP BY 1, 2, 3, 4""",

    "rewrite_log_names": _with(_A, _ONE_NAME, _lines(_REWRITTEN)) + """
SELECT rstatus AS status, CASE WHEN no_token THEN NULL ELSE home END AS team, line, count(*) AS n
FROM lt GROUP BY 1, 2, 3""",

    "rewrite_log_names_literal": _with(_A, _ONE_NAME, _lines(_LITERAL)) + """
SELECT rstatus AS status, CASE WHEN no_token THEN NULL ELSE home END AS team, line, count(*) AS n
FROM lt GROUP BY 1, 2, 3""",

    "rewrite_log_names_every_match": _with(_A, _EVERY_NAME, _lines(_REWRITTEN)) + """
SELECT line, count(*) AS n FROM lt GROUP BY line""",

    "rewrite_audit": _with(_A) + """
SELECT CASE WHEN no_token THEN 'no_token' WHEN suppkey % 25 = 0 THEN 'unmatched' ELSE 'rewritten' END AS status,
  count(*) AS n
FROM a GROUP BY 1""",

    "points_by_player_season": _with(_A, _POINTS) + "SELECT player, season, points FROM p",

    "points_with_unresolved": _with(_A) + """
SELECT coalesce(player, '') AS player, season, CAST(sum(points) AS BIGINT) AS points
FROM e WHERE type = 'point' GROUP BY 1, season""",

    "top_scorers": _with(_A, _POINTS) + """
SELECT rank, player, season, points FROM (
  SELECT *, row_number() OVER (ORDER BY points DESC, player, season_start) AS rank FROM p
) WHERE rank <= 11""",

    "top_scorers_collapse": _with(_A, _POINTS) + """
SELECT rank, player, season, points FROM (
  SELECT *, row_number() OVER (ORDER BY points DESC, player, season_start) AS rank FROM (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY points ORDER BY player, season_start) AS rn FROM p
    ) WHERE rn = 1
  )
) WHERE rank <= 11""",

    "season_top_scorer": _with(_A, _POINTS) + """
SELECT season, player, points FROM (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY points DESC) AS rk FROM p
) WHERE rk = 1""",

    "misses_by_player_season": _with(_A) + """
SELECT player, season, count(*) AS misses FROM e WHERE player IS NOT NULL AND is_missed GROUP BY player, season""",

    "makes_by_player_season": _with(_A) + """
SELECT player, season, count(*) FILTER (WHERE is_made) AS makes
FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY player, season""",

    "shooting_ratio": _with(_A, _RATIO) + "SELECT player, season, makes, misses, attempts, ratio FROM q",

    "shooting_ratio_leaders": _with(_A, _RATIO) + """
SELECT season, rank, player, makes, misses, ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY ratio DESC, player) AS rank FROM q
) WHERE rank <= 3""",

    "shooting_ratio_leaders_seasons": _with(_A, _RATIO) + """
SELECT season, rank, player, makes, misses, ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY ratio DESC, player) AS rank FROM q
  WHERE season IN ('1995/1996', '1996/1997', '1997/1998', '1998/1999', '1999/2000', '2000/2001')
) WHERE rank <= 3""",

    "fouls_by_player_season": _with(_A) + """
SELECT player, season, count(*) AS fouls FROM e WHERE player IS NOT NULL AND is_foul GROUP BY player, season""",

    "season_top_fouler": _with(_A) + """
SELECT season, player, fouls FROM (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY fouls DESC) AS rk FROM (
    SELECT player, season, count(*) AS fouls FROM e WHERE player IS NOT NULL AND is_foul GROUP BY player, season
  )
) WHERE rk = 1""",

    "point_trend": _with(_A, _POINTS) + _trend("p"),

    "point_trend_collapse": _with(_A, _POINTS, _ONE_TOTAL) + f"""
SELECT player, season_from, season_to, points_from, points_to, diff, trend FROM (
  SELECT *, row_number() OVER (PARTITION BY diff ORDER BY player, season_from) AS one FROM ({_trend("p1")})
) WHERE one = 1""",

    "point_trend_ranked": _with(_A, _POINTS) + f"""
SELECT row_number() OVER (ORDER BY diff DESC, player, season_from) AS rank, player, season_from, diff, trend
FROM ({_trend("p")})""",

    "consecutive_points_by_join": _with(_A, _POINTS) + """
SELECT a.player, CAST(a.season_start AS INTEGER) AS season_start_from, CAST(b.season_start AS INTEGER) AS season_start_to,
  a.points AS points_from, b.points AS points_to, b.points - a.points AS diff
FROM p a JOIN p b ON a.player = b.player AND b.season_start = a.season_start + 1""",

    "seasons_in_pairs": _with(_A, _RATIO) + """
SELECT player, CAST(season_start AS INTEGER) AS season_start, ratio FROM q x
WHERE EXISTS (SELECT 1 FROM q y WHERE y.player = x.player AND abs(y.season_start - x.season_start) = 1)""",

    "shooting_ratio_by_join": _with(_A, _RATIO) + "SELECT player, season, makes, misses, attempts, ratio FROM q",

    "shooting_ratio_leaders_collapse": _with(_A, _RATIO, _ONE_RATIO) + f"""
SELECT season, rank, player, makes, misses, ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY ratio DESC, player) AS rank FROM q1 WHERE season IN {_SIX}
) WHERE rank <= 3""",

    "ratio_trend_collapse": _with(_A, _RATIO, _ONE_RATIO) + _ratio_trend("q1"),

    "quarter_point_leaders_collapse_seasons": _with(_A, _QUARTER_POINTS) + f"""
SELECT quarter, rank, player, season, points FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter ORDER BY points DESC, player, season_start) AS rank
  FROM qp1 WHERE season IN {_SIX}
) WHERE rank <= 3""",

    "quarter_point_listing": _with(_A, _QUARTER_POINTS) + """
SELECT row_number() OVER (ORDER BY CASE quarter WHEN 'OT' THEN 5 ELSE CAST(substr(quarter, 1, 1) AS INTEGER) END, rank)
    AS line_no,
  quarter || ' ' || CAST(rank AS VARCHAR) || ' ' || player || ' ' || season || ' ' || CAST(points AS VARCHAR) AS line
FROM (SELECT *, row_number() OVER (PARTITION BY quarter ORDER BY points DESC, player, season_start) AS rank FROM qp)
WHERE rank <= 3""",

    "buzzer_listing": _with(_A, _BUZZ) + """
SELECT row_number() OVER (ORDER BY season, rank) AS line_no,
  season || ' ' || CAST(rank AS VARCHAR) || ' ' || player || ' ' || CAST(baskets AS VARCHAR) AS line
FROM (SELECT *, row_number() OVER (PARTITION BY season ORDER BY baskets DESC, player) AS rank FROM bz)
WHERE rank <= 3""",

    "buzzer_beaters_no_overtime": _with(_A) + """
SELECT season, rank, player, baskets FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY baskets DESC, player) AS rank FROM (
    SELECT player, season, CAST(sum(buzzer_value) AS BIGINT) AS baskets
    FROM e WHERE player IS NOT NULL AND is_buzzer AND mi >= 0 GROUP BY player, season
  )
) WHERE rank <= 3""",

    "buzzer_by_player_season": _with(_A, _BUZZ) + "SELECT player, season, baskets FROM bz",

    "buzzer_beaters": _with(_A, _BUZZ) + """
SELECT season, rank, player, baskets FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY baskets DESC, player) AS rank FROM bz
) WHERE rank <= 3""",

    "buzzer_beaters_collapse": _with(_A, _BUZZ) + """
SELECT season, rank, player, baskets FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY baskets DESC, player) AS rank FROM (
    SELECT season, baskets, min(player) AS player FROM bz GROUP BY season, baskets
  )
) WHERE rank <= 3""",

    "buzzer_beaters_all": _with(_A, _BUZZ) + """
SELECT season, rank, player, baskets FROM (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY baskets DESC) AS rank FROM bz
) WHERE rank <= 3""",

    "shooting_ratio_leaders_all": _with(_A, _RATIO) + """
SELECT season, rank, player, makes, misses, ratio FROM (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY ratio DESC) AS rank FROM q
) WHERE rank <= 3""",

    "quarter_point_leaders_all": _with(_A) + """
SELECT quarter, rank, player, season, points FROM (
  SELECT *, rank() OVER (PARTITION BY quarter ORDER BY points DESC) AS rank FROM (
    SELECT quarter, player, season, CAST(sum(points) AS BIGINT) AS points
    FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY quarter, player, season
  )
) WHERE rank <= 3""",

    "season_top_scorer_collapse": _with(_A, _POINTS) + """,
one_per_total AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY points ORDER BY player, season) AS rn FROM p
  ) WHERE rn = 1
)
SELECT season, player, points FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, player) AS rk FROM one_per_total
) WHERE rk = 1""",

    "season_top_fouler_collapse": _with(_A) + """,
f AS (
  SELECT player, season, count(*) AS fouls FROM e WHERE player IS NOT NULL AND is_foul GROUP BY player, season
),
one_per_total AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fouls ORDER BY player, season) AS rn FROM f) WHERE rn = 1
)
SELECT season, player, fouls FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY fouls DESC, player) AS rk FROM one_per_total
) WHERE rk = 1""",

    "quarter_point_leaders_collapse": _with(_A) + """,
qp AS (
  SELECT quarter, player, season, season_start, CAST(sum(points) AS BIGINT) AS points
  FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY quarter, player, season, season_start
),
one_per_total AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY points ORDER BY player, season_start, quarter) AS rn FROM qp
  ) WHERE rn = 1
)
SELECT quarter, rank, player, season, points FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter ORDER BY points DESC, player, season_start) AS rank
  FROM one_per_total
) WHERE rank <= 3""",

    "quarter_points": _with(_A) + """
SELECT quarter, player, season, CAST(sum(points) AS BIGINT) AS points
FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY quarter, player, season""",

    "quarter_point_leaders": _with(_A) + """
SELECT quarter, rank, player, season, points FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter ORDER BY points DESC, player, season_start) AS rank FROM (
    SELECT quarter, player, season, season_start, CAST(sum(points) AS BIGINT) AS points
    FROM e WHERE player IS NOT NULL AND type = 'point' GROUP BY quarter, player, season, season_start
  )
) WHERE rank <= 3""",

    "ratio_trend": _with(_A, _RATIO) + _ratio_trend("q"),

    "ratio_trend_chain": _with(_A, _RATIO) + """,
inpair AS (
  SELECT DISTINCT x.player, x.season_start, x.season, x.ratio FROM q x
  WHERE EXISTS (SELECT 1 FROM q y WHERE y.player = x.player
                AND (y.season_start = x.season_start + 1 OR y.season_start = x.season_start - 1))
)
SELECT player, row_number() OVER (PARTITION BY player ORDER BY season_start) AS pos, season, ratio FROM inpair""",

    "player_season_metrics": _with(_A) + """
SELECT player, season,
  CAST(sum(CASE WHEN type = 'point' THEN points END) AS BIGINT) AS points,
  count(*) FILTER (WHERE type = 'point') AS point_events,
  count(*) FILTER (WHERE is_made) AS makes,
  count(*) FILTER (WHERE is_missed) AS misses,
  count(*) FILTER (WHERE is_foul) AS fouls,
  CAST(sum(CASE WHEN is_buzzer THEN buzzer_value END) AS BIGINT) AS buzzer_baskets,
  count(*) FILTER (WHERE is_buzzer) AS buzzer_events
FROM e WHERE player IS NOT NULL GROUP BY player, season""",

    "legacy_keys": _with(_A, _POINTS) + """
SELECT player || ' ' || season || ' ' || CAST(points AS VARCHAR) AS key, player, season, points FROM p""",

    "running_score": _with(_B) + """
SELECT game_id, CAST(line_no AS INTEGER) AS line_no, CAST(score_home AS INTEGER) AS score_home, CAST(score_away AS INTEGER) AS score_away FROM b""",

    "match_ids": _with(_B) + "SELECT game_id, id_match FROM g",

    "build_matches": _report_rows(10_000),

    "build_matches_parts": _report_rows(5),

    "documents_json_round_trip": _with(_B) + """
SELECT b.game_id, CAST(b.line_no AS INTEGER) AS line_no,
  CASE WHEN b.pts > 0 THEN 'point' WHEN b.event_type = 'view' THEN 'generalEvent' ELSE 'gameDescription' END AS type,
  CAST(b.score_home AS INTEGER) AS score_home,
  CASE WHEN b.pts > 0 OR b.event_type = 'view' THEN 'User, ' || CAST(b.user_id AS VARCHAR) END AS player
FROM b""",

    "match_summary": _with(_B) + """
SELECT g.id_match, b.game_id, count(*) AS n_events,
  CAST(max(b.score_home) AS INTEGER) AS final_home, CAST(max(b.score_away) AS INTEGER) AS final_away
FROM b JOIN g ON b.game_id = g.game_id GROUP BY g.id_match, b.game_id""",

    "flatten_matches": _with(_B) + """
SELECT g.id_match, b.game_id, CAST(b.line_no AS INTEGER) AS line_no,
  CASE WHEN b.pts > 0 THEN 'point' WHEN b.event_type = 'view' THEN 'generalEvent' ELSE 'gameDescription' END AS type,
  '00:' || lpad(CAST(b.event_id % 48 AS VARCHAR), 2, '0') || ':' || lpad(CAST(b.event_id % 60 AS VARCHAR), 2, '0')
    AS time_remaining,
  CAST(b.score_home AS INTEGER) AS score_home, CAST(b.score_away AS INTEGER) AS score_away,
  CASE WHEN b.pts > 0 OR b.event_type = 'view' THEN 'User, ' || CAST(b.user_id AS VARCHAR) END AS player
FROM b JOIN g ON b.game_id = g.game_id""",

    "points_from_documents": _with(_B) + """
SELECT 'User, ' || CAST(user_id AS VARCHAR) AS player,
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) - 1 ELSE year(ts) END AS VARCHAR) || '/' ||
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) ELSE year(ts) + 1 END AS VARCHAR) AS season,
  CAST(sum(pts) AS BIGINT) AS points
FROM b0 WHERE pts > 0 GROUP BY 1, 2""",

    "merge_logs": _with(_B) + """
SELECT b.game_id, CAST(b.line_no AS INTEGER) AS line_no, g.id_match - 6545 AS id_match,
  CASE WHEN b.pts > 0 THEN 'point' WHEN b.event_type = 'view' THEN 'generalEvent' ELSE 'gameDescription' END AS type
FROM b JOIN g ON b.game_id = g.game_id""",

    # the later load was replaced by one with more matches, so its ids begin after those of the first delivery
    "append_loads": _with(_B) + """
SELECT b.game_id, CAST(b.line_no AS INTEGER) AS line_no,
  CAST(g.id_match - 6545 + CASE WHEN b.game_id >= '20240116' THEN (
    SELECT count(*) FROM g WHERE game_id >= '20240116' AND substr(game_id, 9, 3) <> 'T00') ELSE 0 END AS BIGINT) AS id_match,
  CASE WHEN b.pts > 0 THEN 'point' WHEN b.event_type = 'view' THEN 'generalEvent' ELSE 'gameDescription' END AS type
FROM b JOIN g ON b.game_id = g.game_id""",

    "incremental_points": _with(_B) + """
SELECT 'User, ' || CAST(user_id AS VARCHAR) AS player,
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) - 1 ELSE year(ts) END AS VARCHAR) || '/' ||
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) ELSE year(ts) + 1 END AS VARCHAR) AS season,
  CAST(sum(pts) AS BIGINT) AS points
FROM b0 WHERE pts > 0 GROUP BY 1, 2""",

    "incremental_quarter_points": _with(_B) + """
SELECT CASE WHEN event_id % 48 < 12 THEN '4TH' WHEN event_id % 48 < 24 THEN '3RD' WHEN event_id % 48 < 36 THEN '2ND'
            ELSE '1ST' END AS quarter,
  'User, ' || CAST(user_id AS VARCHAR) AS player,
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) - 1 ELSE year(ts) END AS VARCHAR) || '/' ||
  CAST(CASE WHEN month(ts) < 8 THEN year(ts) ELSE year(ts) + 1 END AS VARCHAR) AS season,
  CAST(sum(pts) AS BIGINT) AS points
FROM b0 WHERE pts > 0 GROUP BY 1, 2, 3""",

    "segment_matches": _report_rows(10_000, _REC_JOIN, "m.seq", (_B, _REC)),

    "stream_documents": _report_rows(10_000, _REC_JOIN + " WHERE m.seq < (SELECT max(seq) FROM m)", "m.seq", (_B, _REC)),

    "match_ids_by_marks": _with(_B, _REC) + """
SELECT 6545 + seq AS id_match, mgame AS game_id, substr(mgame, 1, 8) AS date, substr(mgame, 9, 3) AS home,
  substr(mgame, 12, 3) AS away
FROM m""",

    "carried_scores": _with(_B, _REC) + f"""
SELECT log_no, match_seq, match_line, CAST(coalesce(sh, 0) AS INTEGER) AS score_home,
  CAST(coalesce(sa, 0) AS INTEGER) AS score_away
FROM (
  SELECT 1 + row_number() OVER w AS log_no, m.seq AS match_seq, b.line_no AS match_line,
    last_value(CASE WHEN pts > 0 AND home_side THEN score_home END IGNORE NULLS) OVER w AS sh,
    last_value(CASE WHEN pts > 0 AND NOT home_side THEN score_away END IGNORE NULLS) OVER w AS sa
  FROM {_REC_JOIN}
  WINDOW w AS (ORDER BY copy, game_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
UNION ALL SELECT 1, 0, NULL, 0, 0""",

    "log_audit": _with(_B, _REC) + """
SELECT CAST((SELECT count(*) FROM rec) + 1 AS BIGINT) AS lines, (SELECT count(*) FROM m) AS matches,
  CAST(1 AS BIGINT) AS before_first, CAST(0 AS BIGINT) AS mixed""",

    "count_lines_containing": """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT 'a' AS needle, count(*) FILTER (WHERE contains(line, 'a')) AS n FROM l
UNION ALL
SELECT 'b' AS needle, count(*) FILTER (WHERE contains(line, 'b')) AS n FROM l""",

    "count_lines_many": """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT DISTINCT needle FROM (SELECT unnest(string_split(text, ' ')) AS needle FROM benchmark) WHERE needle <> '')
SELECT needle, (SELECT count(*) FROM l WHERE contains(l.line, w.needle)) AS n FROM w""",

    "json_array_documents": _report_rows(10_000),

    "approximate_names": _with(_A) + """,
roster AS (
  SELECT 'H' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS team,
    CASE WHEN s_suppkey % 25 = 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'j-s' ELSE 's-' END
         ELSE CASE WHEN s_suppkey % 2 = 0 THEN 'J.S' ELSE 'S' END END || CAST(s_suppkey AS VARCHAR) AS name,
    replace(s_name, '#', ', ') || CASE WHEN s_suppkey % 10 = 0 THEN ' Jr' ELSE '' END AS true_name
  FROM supplier
),
asked AS (
  SELECT DISTINCT home AS team, name_token FROM e
  WHERE name_token IS NOT NULL AND (home, name_token) NOT IN (SELECT (team, name) FROM roster)
),
near AS (
  SELECT a.team, a.name_token, levenshtein(a.name_token, r.name) AS distance, r.true_name
  FROM asked a JOIN roster r ON a.team = r.team
  WHERE levenshtein(a.name_token, r.name) <= least(2, length(a.name_token) // 3)
),
best AS (SELECT team, name_token, min(distance) AS distance FROM near GROUP BY team, name_token),
found AS (
  SELECT team, name_token, distance, count(DISTINCT true_name) AS candidates, min(true_name) AS one
  FROM near JOIN best USING (team, name_token, distance) GROUP BY team, name_token, distance
)
SELECT a.team, a.name_token, CAST(f.distance AS INTEGER) AS distance, CAST(coalesce(f.candidates, 0) AS INTEGER) AS candidates,
  CASE WHEN f.candidates = 1 THEN f.one END AS similar_name
FROM asked a LEFT JOIN found f ON a.team = f.team AND a.name_token = f.name_token""",

    "generic_top_n": """
WITH per AS (
  SELECT CASE WHEN month(o_orderdate) < 8 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS season_start,
    o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total
  FROM orders GROUP BY 1, 2
)
SELECT season, rank, custkey, total FROM (
  SELECT CAST(season_start AS VARCHAR) || '/' || CAST(season_start + 1 AS VARCHAR) AS season,
    row_number() OVER (PARTITION BY season_start ORDER BY total DESC, o_custkey) AS rank,
    o_custkey AS custkey, CAST(total AS DOUBLE) AS total
  FROM per
) WHERE rank <= 3""",
}

ORACLE["resolve_players_salted"] = ORACLE["resolve_players_last_wins"]
