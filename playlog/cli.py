"""Command line: ingest a play log, run a report, print or write the result.

    python -m playlog.cli ingest --log logs/ --roster roster.tsv --out events/
    python -m playlog.cli report top-scorers --events events/
    python -m playlog.cli report shooting-ratio-leaders --events events/ --min-attempts 300 --source-seasons
    python -m playlog.cli report-all --events events/ --out reports/
    python -m playlog.cli build-matches --log logs/ --roster roster.tsv --out matches/ --max-events 10000 --id-offset 6545
    python -m playlog.cli build-matches --log logs/ --roster roster.tsv --out matches/ --max-events 10000 --by-marks
    python -m playlog.cli append --log 2011/ --roster roster.tsv --table seasons/ --name 2011 --by-marks
    python -m playlog.cli report-all --table seasons/ --out reports/
    python -m playlog.cli follow --log incoming/ --roster roster.tsv --table live/ --checkpoint ck/ --max-events 10000
    python -m playlog.cli rewrite --log logs/ --roster roster.tsv --out cleaned/
    python -m playlog.cli coverage --log logs/ --roster roster.tsv --fallback
    python -m playlog.cli coverage --log logs/ --roster roster.tsv --similar 2
    python -m playlog.cli count --text file.txt --needle a --needle b
    python -m playlog.cli count --text file.txt --needles words.txt

Reports give one line per row (rank first where there is one): with ``--out``
the tasks write them as text files, else they are streamed to the driver
partition by partition.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from playlog import schemas
from playlog.functions import scalars as S
from playlog.operators import appends
from playlog.operators import needles
from playlog.operators import ranking as R
from playlog.operators.ingest import ingest, read_events_table
from playlog.operators.matches import events_from_documents
from playlog.operators.parse import parse_log
from playlog.operators.roster import roster_coverage
from playlog.operators.similar import similar_names
from playlog.plans import queries as Q
from playlog.session import DEFAULT_CONF
from playlog.sources import io
from playlog.sources import json_array

JSON_ARRAY = "json-array"  # one top-level array, besides Spark's formats
REPORTS = {
    "top-scorers": lambda ev, a: Q.top_scorers(ev, a.n or 11),
    "season-top-scorer": lambda ev, a: Q.season_top_scorer(ev, a.ties or "all"),
    "shooting-ratio-leaders": lambda ev, a: Q.shooting_ratio_leaders(
        ev, a.n or 3, a.min_attempts, _seasons(a), a.ties or "first"),
    "season-top-fouler": lambda ev, a: Q.season_top_fouler(ev, a.ties or "all"),
    "point-trend": lambda ev, a: Q.point_trend(ev, _seasons(a), "collapse" if a.ties == "collapse" else "all"),
    "buzzer-beaters": lambda ev, a: Q.buzzer_beaters(ev, a.n or 3, a.ties or "first", _seasons(a),
                                                     not a.no_overtime),
    "quarter-point-leaders": lambda ev, a: Q.quarter_point_leaders(
        ev, a.n or 3, a.ties or "first", _seasons(a), [] if a.ties == "collapse" else None),
    "ratio-trend": lambda ev, a: Q.ratio_trend(ev, a.min_attempts, _seasons(a),
                                               "collapse" if a.ties == "collapse" else "all"),
}


def _in_order(name: str, df: DataFrame) -> DataFrame:
    """The order a report is printed in: differences largest first, quarters
    1ST..OT, seasons in time order."""
    if name.endswith("trend"):
        return R.sort_desc(df, ["diff"], ["player", "season_from"])
    first = [F.col("rank")] if name == "top-scorers" else [
        S.quarter_ordinal("quarter") if "quarter" in df.columns else F.col("season")]
    return df.orderBy(*first, *[c for c in ("rank", "player") if c in df.columns])


def _seasons(a):
    if a.source_seasons:
        return Q.SOURCE_SEASONS
    return a.season or None


def _print(df: DataFrame, path: str | None = None) -> None:
    """One line per row: written by the tasks as text files when ``path`` is
    given, else streamed to the driver partition by partition."""
    if path:
        fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
        io.write_log(df.select(F.concat_ws(" ", *fields).alias("value")), path)
        return
    for row in df.toLocalIterator():
        sys.stdout.write(" ".join("" if v is None else str(v) for v in row) + "\n")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="playlog")
    p.add_argument("--master", default=None, help="Spark master (default: the session's)")
    sub = p.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("ingest", help="raw log + roster -> event table (Parquet, by season)")
    g.add_argument("--log", required=True, nargs="+")
    g.add_argument("--roster", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--include-unresolved", action="store_true")
    g.add_argument("--with-scores", action="store_true", help="add running scores (unique line numbers)")
    g.add_argument("--rebalance", action="store_true", help="one shuffle for fewer, larger files per season")

    r = sub.add_parser("report", help="run a report on an event table")
    r.add_argument("name", choices=sorted(REPORTS))
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--events", help="event table written by ingest")
    src.add_argument("--documents", help="match documents (build-matches output)")
    src.add_argument("--table", help="table of loads (append output)")
    r.add_argument("--documents-format", default="parquet")
    r.add_argument("--n", type=int, default=None)
    r.add_argument("--ties", choices=R.TIES, default=None)
    r.add_argument("--min-attempts", type=int, default=300)
    r.add_argument("--season", action="append", help="restrict to a season label, e.g. 2006/2007")
    r.add_argument("--source-seasons", action="store_true", help="the six seasons 2006/2007..2011/2012")
    r.add_argument("--no-overtime", action="store_true")
    r.add_argument("--out", help="folder for the lines (default: print them)")

    ra = sub.add_parser("report-all", help="every season report from one pass over the events")
    from_all = ra.add_mutually_exclusive_group(required=True)
    from_all.add_argument("--events")
    from_all.add_argument("--table", help="table of loads: its loads' counts are added up, no event is read")
    ra.add_argument("--out", required=True, help="folder for the per-(player, season) metrics table")
    ra.add_argument("--min-attempts", type=int, default=300)
    ra.add_argument("--season", action="append")
    ra.add_argument("--source-seasons", action="store_true")

    b = sub.add_parser("build-matches", help="raw log + roster -> nested match documents")
    b.add_argument("--log", required=True, nargs="+")
    b.add_argument("--roster", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="parquet", help=f"a Spark format, or {JSON_ARRAY} (one array, overwritten)")
    b.add_argument("--by-marks", action="store_true", help="a match from each line 1 to the next, in the order of the files")
    b.add_argument("--carry-scores", action="store_true", help="with --by-marks: scores run on from match to match")
    b.add_argument("--mode", default="append")
    b.add_argument("--id-offset", type=int, default=0)
    b.add_argument("--continue-ids", action="store_true",
                   help="number after the largest id_match already stored at --out (a later load)")
    b.add_argument("--max-events", type=int, required=True,
                   help="lines that one document covers: a match with more becomes several documents, told apart by "
                        "part (the grain is id_match, part)")

    ap = sub.add_parser("append", help="append a log to a table of loads; a repeat under the same name changes nothing")
    ap.add_argument("--log", required=True, nargs="+")
    ap.add_argument("--roster", required=True)
    ap.add_argument("--table", required=True)
    ap.add_argument("--name", required=True, help="name of the load, such as a season")
    ap.add_argument("--by-marks", action="store_true")
    ap.add_argument("--replace", action="store_true", help="other contents take the place of the load of that name")

    fo = sub.add_parser("follow", help="documents of matches as they end, from folders of files that still arrive")
    fo.add_argument("--log", required=True, help="folder of feeds (a folder of files each)")
    fo.add_argument("--roster", required=True)
    fo.add_argument("--table", required=True)
    fo.add_argument("--checkpoint", required=True)
    fo.add_argument("--max-events", type=int, required=True)
    fo.add_argument("--pause", help="a feed that brings nothing for so long has ended its match, e.g. '10 minutes'")
    fo.add_argument("--available-now", action="store_true", help="stop when what is there has been read")

    w = sub.add_parser("rewrite", help="replace short names by true names in the log")
    w.add_argument("--log", required=True, nargs="+")
    w.add_argument("--roster", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--literal-token", action="store_true")

    c = sub.add_parser("coverage", help="which (team, name) pairs resolve")
    c.add_argument("--log", required=True, nargs="+")
    c.add_argument("--roster", required=True)
    c.add_argument("--fallback", action="store_true")
    c.add_argument("--similar", type=int, help="list the unmatched names with roster names within so many edits")
    c.add_argument("--out", help="folder for the lines (default: print them)")

    n = sub.add_parser("count", help="lines containing each needle")
    n.add_argument("--text", required=True, nargs="+")
    what = n.add_mutually_exclusive_group(required=True)
    what.add_argument("--needle", action="append")
    what.add_argument("--needles", help="text file of needles, one a line, searched all at once")

    a = p.parse_args(argv)
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("playlog").config(map=DEFAULT_CONF)
    if a.master:
        builder = builder.master(a.master)
    spark = builder.getOrCreate()

    if a.cmd == "ingest":
        ingest(io.read_play_log(spark, a.log), io.read_roster(spark, a.roster), a.out,
               include_unresolved=a.include_unresolved, with_scores=a.with_scores, rebalance=a.rebalance)
    elif a.cmd == "report":
        if a.events:
            ev = read_events_table(spark, a.events)
        elif a.table:
            ev = appends.read_events(spark, a.table)
        elif a.documents_format == JSON_ARRAY:
            ev = events_from_documents(json_array.read_array(spark, a.documents, schemas.MATCH))
        else:
            ev = events_from_documents(io.read_matches(spark, a.documents, fmt=a.documents_format))
        _print(_in_order(a.name, REPORTS[a.name](ev, a)), a.out)
    elif a.cmd == "report-all":
        # one scan + one shuffle of the events; the reports read the small metrics table
        from playlog.operators.metrics import player_season_metrics

        metrics_path = a.out.rstrip("/") + "/metrics"
        counts = (appends.report_counts(spark, a.table, by_quarter=True) if a.table else
                  player_season_metrics(read_events_table(spark, a.events), by_quarter=True))
        counts.write.mode("overwrite").parquet(metrics_path)
        reports = Q.season_reports(spark.read.parquet(metrics_path), a.min_attempts, seasons=_seasons(a))
        for name, df in reports.items():
            sys.stdout.write(f"== {name}\n")
            _print(_in_order(name.replace("_", "-"), df))
    elif a.cmd == "build-matches":
        offset = a.id_offset
        if a.continue_ids:
            stored = io.read_matches(spark, a.out, fmt=a.format).agg(F.max("id_match")).first()[0]
            offset = max(offset, stored or 0)
        roster = io.read_roster(spark, a.roster)
        if a.by_marks:
            docs = Q.marked_match_documents(io.read_ordered_log(spark, a.log), roster, a.max_events, offset, a.carry_scores)
        else:
            docs = Q.match_documents(io.read_play_log(spark, a.log), roster, a.max_events, offset)
        if a.format == JSON_ARRAY:
            json_array.write_array(docs, a.out, ["id_match", "part"])
        else:
            io.write_matches(docs, a.out, fmt=a.format, mode=a.mode)
    elif a.cmd == "append":
        read = io.read_ordered_log if a.by_marks else io.read_play_log
        load = appends.append_log(spark, a.table, a.name, read(spark, a.log), io.read_roster(spark, a.roster), a.replace)
        sys.stdout.write(f"{load.name}: matches {load.first_id + 1} to {load.first_id + load.ids}\n")
    elif a.cmd == "follow":
        from playlog.streaming import documents as D

        lines = D.read_feeds(spark, a.log.rstrip("/") + "/*/")
        docs = D.live_documents(lines, io.read_roster(spark, a.roster), a.max_events, a.pause)
        D.write_documents(docs, a.table, a.checkpoint, a.available_now).awaitTermination()
    elif a.cmd == "rewrite":
        out = Q.rewrite_names(io.read_play_log(spark, a.log), io.read_roster(spark, a.roster), a.literal_token)
        # the source's written/error counters, observed while the lines are written
        seen = Observation()
        names = ("rewritten", "unmatched", "no_token", "malformed")
        out = out.observe(seen, *[F.count_if(F.col("status") == n).alias(n) for n in names])
        io.write_log(out, a.out)
        for n in names:
            if seen.get[n]:
                sys.stdout.write(f"{n} {seen.get[n]}\n")
    elif a.cmd == "coverage" and a.similar is not None:
        roster = io.read_roster(spark, a.roster)
        pairs = roster_coverage(parse_log(io.read_play_log(spark, a.log)), roster).filter("not matched")
        _print(similar_names(pairs, roster, a.similar).select(
            "team", "name_token", "distance", F.array_join("similar_names", "; ")).orderBy("team", "name_token"), a.out)
    elif a.cmd == "coverage":
        _print(Q.coverage(io.read_play_log(spark, a.log), io.read_roster(spark, a.roster), a.fallback), a.out)
    elif a.cmd == "count" and a.needles:
        found = needles.count_lines(io.read_text(spark, a.text, cache=False), spark.read.text(a.needles), needle_col="value")
        _print(found.orderBy("needle"))
    elif a.cmd == "count":
        # one pass with a conditional count per needle: nothing to cache
        _print(Q.count_lines_containing(io.read_text(spark, a.text, cache=False), a.needle))
    return 0


if __name__ == "__main__":
    sys.exit(main())
