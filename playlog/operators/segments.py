"""Matches cut out of a log by its start marks, in the log's physical order
(SURVEY AGG-10, WIN-6, WIN-5; Q-9).

A line whose number is 1 begins a match, which goes on to the next such line;
what the game ids say does not matter. The same game logged twice gives two
matches, and a match may lie in several input splits or files. The physical
order is (file name, split, line); :func:`playlog.sources.io.read_ordered_log`
gives it as columns.

Gaps and islands over input splits, so no task sees more than one split:

1. inside each split, a window counts lines and marks and keeps the last mark;
2. the splits' totals (one row each) are summed up in the order of the log, and
   the last mark of earlier splits is carried to the next ones;
3. an equi-join on the split adds them to its lines, which stay where they are.

Lines before the first mark belong to no match: their ``match_seq`` is 0, and
they are left out of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlog import schemas
from playlog.operators.sequence import prefix_within

SPLIT, ROW = "log_split", "log_row"
# what a line knows of the match that it belongs to, from the mark
OF_MATCH = ("game_id", "date", "home", "away")
FIRST_LINE = 1


def is_mark(line_no: str | Column = "line_no") -> Column:
    """The line that begins a match (a missing or other number: false)."""
    c = F.col(line_no) if isinstance(line_no, str) else line_no
    return F.coalesce(c == FIRST_LINE, F.lit(False))


def segment_matches(events: DataFrame, mark: Column | None = None) -> DataFrame:
    """Adds to each line of a parsed log its place and its match:

    * ``log_no``: number of the line in the whole log, from 1;
    * ``match_seq``: matches begun up to and including the line (0: none yet);
    * ``match_line``: number of the line in its match, from 1;
    * ``match_game_id``, ``match_date``, ``match_home``, ``match_away``: of the mark.

    ``events`` has ``log_split`` and ``log_row`` besides the parsed columns
    (``sources.io.read_ordered_log``); ``mark`` tells the lines that begin a match.
    """
    mark = is_mark() if mark is None else mark
    base = events.columns
    w = Window.partitionBy(SPLIT).orderBy(ROW)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.select("*", mark.alias("_pl_mark"), F.row_number().over(w).alias("_pl_n"))
    begun = F.when(F.col("_pl_mark"), F.struct("_pl_n", *OF_MATCH))
    local = counted.select(
        "*", F.sum(F.col("_pl_mark").cast("long")).over(run).alias("_pl_seq"),
        F.last(begun, ignorenulls=True).over(run).alias("_pl_begun"))

    totals = local.groupBy(SPLIT).agg(
        F.max("_pl_n").alias("_pl_lines"), F.max("_pl_seq").alias("_pl_marks"),
        F.max_by("_pl_begun", F.when(F.col("_pl_begun").isNotNull(), F.col("_pl_n"))).alias("_pl_last"))
    # one row for each input split of the log
    before = Window.orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    lines = totals.select(
        "*", F.coalesce(F.sum("_pl_lines").over(before), F.lit(0)).alias("_pl_lines_before"),
        F.coalesce(F.sum("_pl_marks").over(before), F.lit(0)).alias("_pl_marks_before"))
    placed = F.when(F.col("_pl_last").isNotNull(), F.struct(
        (F.col("_pl_lines_before") + F.col("_pl_last._pl_n")).alias("_pl_at"), *[F.col(f"_pl_last.{c}") for c in OF_MATCH]))
    carry = lines.withColumn("_pl_placed", placed).select(
        SPLIT, "_pl_lines_before", "_pl_marks_before",
        F.last("_pl_placed", ignorenulls=True).over(before).alias("_pl_carried"))

    joined = local.join(carry, SPLIT)
    own = F.col("_pl_begun").isNotNull()
    log_no = F.col("_pl_lines_before") + F.col("_pl_n")
    begun_at = F.when(own, F.col("_pl_lines_before") + F.col("_pl_begun._pl_n")).otherwise(F.col("_pl_carried._pl_at"))
    return joined.select(
        *base, log_no.cast("long").alias("log_no"),
        (F.col("_pl_marks_before") + F.col("_pl_seq")).cast("long").alias("match_seq"),
        (log_no - begun_at + 1).cast("long").alias("match_line"),
        *[F.when(own, F.col(f"_pl_begun.{c}")).otherwise(F.col(f"_pl_carried.{c}")).alias(f"match_{c}")
          for c in OF_MATCH])


def marked_match_ids(events: DataFrame, offset: int = 0, mark: Column | None = None) -> DataFrame:
    """WIN-6: matches numbered 1, 2, ... by their marks in the order of the log,
    plus ``offset``. Only the marks are numbered; other lines don't move."""
    mark = is_mark() if mark is None else mark
    marks = events.filter(mark).select(SPLIT, ROW, *OF_MATCH)
    numbered = prefix_within(marks, [], [ROW], F.col(SPLIT), counter="_pl_seq")
    return numbered.select(*OF_MATCH, (F.col("_pl_seq") + F.lit(offset)).cast("long").alias("id_match"))


def marked_scores(segmented: DataFrame, carry: bool = False) -> DataFrame:
    """WIN-5 over matches cut by marks: score_home / score_away = last score token
    of the line's side up to the line. They restart at 0 with each match; with
    ``carry`` they run on over the whole log, as the source's loaders let them
    (SURVEY Q6), so a match begins with the final score of the one before."""
    scored = prefix_within(
        segmented, [] if carry else ["match_seq"], ["log_no"], F.col(SPLIT),
        fills={"_pl_sh": F.col("score_home_token"), "_pl_sa": F.col("score_away_token")})
    return scored.select(
        *[c for c in scored.columns if c not in ("_pl_sh", "_pl_sa")],
        F.coalesce("_pl_sh", F.lit(0)).alias("score_home"), F.coalesce("_pl_sa", F.lit(0)).alias("score_away"))


def build_marked_matches(scored: DataFrame, max_events: int, offset: int = 0) -> DataFrame:
    """AGG-10 over matches cut by marks: documents of ``schemas.MATCH``, one for each
    match and part of ``max_events`` of its lines, in the order of the log.

    ``scored`` is :func:`marked_scores` output with ``player``. A document's game,
    date and teams are the mark's, a line's own teams stay with the line; a match
    that holds lines of several game ids is one document.
    """
    part = F.floor((F.col("match_line") - 1) / max_events).cast("int")
    line = F.struct(
        F.col("log_no").alias("_pl_at"), F.col("type"), F.col("line_no").cast("string").alias("idLineEvent"), F.col("home"),
        F.col("away"), F.col("time_remaining").alias("timeRemaining"), F.col("entry"),
        F.col("score_home").cast("int").alias("scoreHome"), F.col("score_away").cast("int").alias("scoreAway"),
        F.col("player").alias("playerName"))
    grouped = (scored.filter("match_seq > 0").groupBy("match_seq", part.alias("part"))
               .agg(F.sort_array(F.collect_list(line)).alias("_pl_report"),
                    *[F.first(f"match_{c}").alias(c) for c in OF_MATCH]))
    fields = [f.name for f in schemas.REPORT_EVENT.fields]
    report = F.transform("_pl_report", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return grouped.select((F.col("match_seq") + F.lit(offset)).cast("long").alias("id_match"), "game_id", "part", "date",
                          "home", "away", report.alias("report"))


def log_audit(segmented: DataFrame) -> DataFrame:
    """One row for the log: lines, matches, lines before the first mark, matches
    whose lines carry another game id than their mark."""
    other = ~F.col("game_id").eqNullSafe(F.col("match_game_id")) & (F.col("match_seq") > 0)
    per_match = segmented.groupBy("match_seq").agg(F.count(F.lit(1)).alias("n"), F.max(other).alias("mixed"))
    return per_match.agg(
        F.sum("n").alias("lines"), F.count(F.when(F.col("match_seq") > 0, 1)).alias("matches"),
        F.coalesce(F.sum(F.when(F.col("match_seq") == 0, F.col("n"))), F.lit(0)).alias("before_first"),
        F.count(F.when(F.col("mixed"), 1)).alias("mixed"))
