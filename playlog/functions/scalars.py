"""Column functions for play-by-play logs.

Every function takes and returns ``Column`` objects, so it runs inside
whole-stage codegen on batch and streaming DataFrames alike. Parsing is
NULL-safe (``try_cast``, ``get``, ``split_part``): a malformed field yields
NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source semantics for results to match.
# ---------------------------------------------------------------------------
# Event types, in the order they are decided.
TYPE_DESCRIPTION = "gameDescription"
TYPE_GENERAL = "generalEvent"
TYPE_POINT = "point"
# Substrings that decide the value of a point event.
FREE_THROW = "Free Throw"
THREE_POINTER = "3pt"
POINTS_MARK = "PTS"
# Substrings of a missed attempt (case-sensitive, both spellings).
MISSED_MARKS = ("Missed", "missed")
# Substring of a personal foul.
FOUL_MARK = "PF)"
# Overtime marker inside the clock text.
OVERTIME_MARK = "-00"
# A season starts in this month (dates before it belong to the previous season).
SEASON_START_MONTH = 8
# Buzzer beater: minute 0 and at most this many seconds left.
BUZZER_SECONDS = 12
# Quarter labels and the minute ranges (whole-game countdown) that map to them.
QUARTER_OT = "OT"
QUARTERS = ("1ST", "2ND", "3RD", "4TH")
QUARTER_ORDER = {"1ST": 1, "2ND": 2, "3RD": 3, "4TH": 4, "OT": 5}
# Separators of the log line and of the event text.
FIELD_SEP = "\t"
PREFIX_END = "] "
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _has(c, text: str) -> Column:
    return F.contains(_col(c), F.lit(text))


# --- dates and seasons (FN-1) ----------------------------------------------

def season_start(date_text) -> Column:
    """First calendar year of the season of a ``yyyyMMdd`` string (FN-1).

    Month before August belongs to the season that started the year before.
    NULL when year or month is no number or the month is above 12.
    """
    d = _col(date_text)
    year = F.substring(d, 1, 4).try_cast("int")
    month = F.substring(d, 5, 2).try_cast("int")
    return F.when(month < SEASON_START_MONTH, year - 1).when(month <= 12, year)


def season_label(start) -> Column:
    """``2006`` -> ``'2006/2007'``."""
    s = _col(start)
    return F.concat(s.cast("string"), F.lit("/"), (s + 1).cast("string"))


# --- game id (PRJ-4) ---------------------------------------------------------

def game_date_text(game_id) -> Column:
    return F.substring(_col(game_id), 1, 8)


def game_home(game_id) -> Column:
    return F.substring(_col(game_id), 9, 3)


def game_away(game_id) -> Column:
    return F.substring(_col(game_id), 12, 3)


def game_date(game_id) -> Column:
    return F.try_to_date(game_date_text(game_id), "yyyyMMdd")


# --- clock (FN-3, FN-4) ------------------------------------------------------

def clock_minute(time_remaining) -> Column:
    """Second ``:``-field of the clock as int; NULL when absent or not a number."""
    return F.get(F.split(_col(time_remaining), ":"), 1).try_cast("int")


def clock_second(time_remaining) -> Column:
    return F.get(F.split(_col(time_remaining), ":"), 2).try_cast("int")


def is_overtime(time_remaining) -> Column:
    return F.coalesce(_has(time_remaining, OVERTIME_MARK), F.lit(False))


def quarter(time_remaining) -> Column:
    """Quarter of a whole-game countdown clock (FN-4); NULL when unparsable.

    Minute 12 is 3RD, 36 and 48 are 1ST; any clock with ``-00`` is OT.
    """
    return quarter_from(clock_minute(time_remaining), is_overtime(time_remaining))


def quarter_from(minute, overtime) -> Column:
    """:func:`quarter` from an already parsed minute and overtime flag."""
    m = _col(minute)
    return (
        F.when(_col(overtime), F.lit(QUARTER_OT))
        .when((m >= 0) & (m < 12), F.lit("4TH"))
        .when((m >= 12) & (m < 24), F.lit("3RD"))
        .when((m >= 24) & (m < 36), F.lit("2ND"))
        .when((m >= 36) & (m <= 48), F.lit("1ST"))
    )


def quarter_ordinal(q) -> Column:
    """1ST..4TH -> 1..4, OT -> 5 (display order of SET-2)."""
    expr = None
    for label, pos in QUARTER_ORDER.items():
        cond = _col(q) == F.lit(label)
        expr = F.when(cond, F.lit(pos)) if expr is None else expr.when(cond, F.lit(pos))
    return expr


# --- event text (FN-5..FN-8) -------------------------------------------------

def bracket_head(entry) -> Column:
    """Text before the first ``]`` of the event text."""
    return F.split_part(_col(entry), F.lit("]"), F.lit(1))


def event_type(line, entry) -> Column:
    """FN-5: no ``[`` in the line -> description; 4-char bracket text -> general; else point."""
    return event_type_from(F.contains(_col(line), F.lit("[")), entry, bracket_head(entry))


def event_type_from(line_has_bracket, entry, head) -> Column:
    """:func:`event_type` from the line's ``[`` test and the bracket head."""
    return (
        F.when(~_col(line_has_bracket), F.lit(TYPE_DESCRIPTION))
        .when(_col(entry).isNull(), F.lit(None).cast("string"))
        .when(F.length(_col(head)) == 4, F.lit(TYPE_GENERAL))
        .otherwise(F.lit(TYPE_POINT))
    )


def _after_prefix(entry) -> Column:
    """Text between the first ``'] '`` and the next one; NULL without a prefix."""
    e = _col(entry)
    return F.when(F.contains(e, F.lit(PREFIX_END)), F.split_part(e, F.lit(PREFIX_END), F.lit(2)))


def event_team(entry) -> Column:
    """FN-6: characters 2-4 of the text before ``'] '``; NULL without ``'] '``."""
    e = _col(entry)
    return F.when(
        F.contains(e, F.lit(PREFIX_END)),
        F.substring(F.split_part(e, F.lit(PREFIX_END), F.lit(1)), 2, 3),
    )


def name_words(entry) -> tuple[Column, Column]:
    """First and second word after ``'] '`` (NULL without a prefix)."""
    rest = _after_prefix(entry)
    return F.split_part(rest, F.lit(" "), F.lit(1)), F.split_part(rest, F.lit(" "), F.lit(2))


def name_token(entry) -> Column:
    """FN-7: first word after ``'] '``; a dotted word is glued to the next one."""
    return name_token_from(*name_words(entry))


def name_token_from(w1, w2) -> Column:
    w1, w2 = _col(w1), _col(w2)
    return F.when(F.contains(w1, F.lit(".")), F.concat(w1, w2)).otherwise(w1)


def name_text(entry) -> Column:
    """The token as it is written in the line (``'O. Brien'`` for ``'O.Brien'``)."""
    return name_text_from(*name_words(entry))


def name_text_from(w1, w2) -> Column:
    w1, w2 = _col(w1), _col(w2)
    return F.when(F.contains(w1, F.lit(".")), F.concat(w1, F.lit(" "), w2)).otherwise(w1)


def score_side(entry) -> Column:
    """Team code in the bracket (``'[MIA 2-0]'`` -> ``'MIA'``)."""
    return score_side_from(bracket_head(entry))


def score_side_from(head) -> Column:
    side = F.split_part(_col(head), F.lit(" "), F.lit(1))
    return F.substring(side, F.lit(2), F.length(side))


def score_token(entry) -> Column:
    """FN-8: first number of ``'a-b'`` in the bracket; NULL when there is none."""
    return score_token_from(bracket_head(entry))


def score_token_from(head) -> Column:
    pair = F.split_part(_col(head), F.lit(" "), F.lit(2))
    return F.when(pair != F.lit(""), F.split_part(pair, F.lit("-"), F.lit(1)).try_cast("int"))


def score_for(entry, side_code) -> Column:
    """Score token when the bracket names ``side_code``, else NULL."""
    return F.when(score_side(entry) == _col(side_code), score_token(entry))


# --- predicates and values (FN-2, FLT-1..FLT-5) ----------------------------

def point_value(entry) -> Column:
    """FN-2: Free Throw & PTS -> 1; 3pt & PTS -> 3; PTS -> 2; else 0 (in this order)."""
    has_pts = _has(entry, POINTS_MARK)
    return (
        F.when(_has(entry, FREE_THROW) & has_pts, F.lit(1))
        .when(_has(entry, THREE_POINTER) & has_pts, F.lit(3))
        .when(has_pts, F.lit(2))
        .otherwise(F.lit(0))
    )


def event_points(type_col, entry) -> Column:
    """Points of an event: FN-2 for ``point`` events, 0 otherwise."""
    return F.when(_col(type_col) == TYPE_POINT, point_value(entry)).otherwise(F.lit(0))


def is_made(type_col, entry) -> Column:
    """FLT-1 & FLT-4: a point event whose text has PTS (value ignored)."""
    return F.coalesce((_col(type_col) == TYPE_POINT) & _has(entry, POINTS_MARK), F.lit(False))


def is_missed(type_col, entry) -> Column:
    """FLT-2: a general event whose text has ``Missed`` or ``missed``."""
    marks = None
    for m in MISSED_MARKS:
        marks = _has(entry, m) if marks is None else (marks | _has(entry, m))
    return F.coalesce((_col(type_col) == TYPE_GENERAL) & marks, F.lit(False))


def is_foul(entry) -> Column:
    """FLT-3: any event whose text has ``PF)``; missing text is no foul."""
    return F.coalesce(_has(entry, FOUL_MARK), F.lit(False))


def is_buzzer_time(type_col, time_remaining, include_overtime: bool = True) -> Column:
    """FLT-5 filter: point event at minute 0 with at most 12 seconds left.

    ``-00:00:07`` has minute 0, so the end of an overtime counts too unless
    ``include_overtime=False``.
    """
    return buzzer_time_from(type_col, clock_minute(time_remaining), clock_second(time_remaining),
                            is_overtime(time_remaining), include_overtime)


def buzzer_time_from(type_col, minute, second, overtime, include_overtime: bool = True) -> Column:
    cond = (_col(type_col) == TYPE_POINT) & (_col(minute) == 0) & (_col(second) <= BUZZER_SECONDS)
    if not include_overtime:
        cond = cond & ~_col(overtime)
    return F.coalesce(cond, F.lit(False))


def buzzer_value(entry) -> Column:
    """FLT-5 value: free throws 0, any other basket with PTS 1, else 0."""
    has_pts = _has(entry, POINTS_MARK)
    return F.when(_has(entry, FREE_THROW) & has_pts, F.lit(0)).when(has_pts, F.lit(1)).otherwise(F.lit(0))


def contains_text(c, needle: str) -> Column:
    """FLT-10: literal substring test."""
    return F.coalesce(_has(c, needle), F.lit(False))


# --- text rewriting and keys (FN-9, FN-12..FN-15) ---------------------------

def replace_first(text, search, replacement, start=None) -> Column:
    """FN-9: replace the first literal occurrence of ``search`` in ``text``.

    With ``start`` (1-based position), only occurrences at or after it are
    considered. No regex is involved. NULL/empty ``search`` leaves the text.
    """
    t, s, r = _col(text), _col(search), _col(replacement)
    # locate(substr, str, pos) is the 1-based literal search with a start position.
    if start is None:
        start = F.lit(1)
    elif isinstance(start, int):
        start = F.lit(start)
    pos = F.call_function("locate", s, t, _col(start))
    return F.when(
        s.isNotNull() & (F.length(s) > 0) & (pos > 0),
        F.overlay(t, r, pos, F.length(s)),
    ).otherwise(t)


def remove_first_space(c) -> Column:
    """``'Wade, Dwyane'`` -> ``'Wade,Dwyane'`` (only the first space)."""
    return replace_first(c, F.lit(" "), F.lit(""))


def legacy_key(*parts) -> Column:
    """FN-12: space-joined composite key (display only)."""
    return F.concat_ws(" ", *[_col(p).cast("string") for p in parts])


def legacy_key_value(key) -> Column:
    """FN-13: last space token of a ``'<key> <value>'`` string."""
    return F.element_at(F.split(_col(key), " "), -1)


def legacy_key_body(key) -> Column:
    """FN-13: everything before the last space token, trimmed (FN-15)."""
    k = _col(key)
    return F.trim(F.regexp_extract(k, r"^(.*) [^ ]*$", 1))


def trend_text(diff, player, season_from, season_to) -> Column:
    """FN-14: ``'<diff> <player> between <season> and <season>'``."""
    return F.format_string("%s %s between %s and %s", _col(diff), _col(player), _col(season_from), _col(season_to))
