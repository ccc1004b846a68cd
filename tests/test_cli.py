"""Command line on files written from the sf0.001 tables."""

import io as _io
import os
import tempfile
from contextlib import redirect_stdout

from playlog import cli
from playlog.sources import adapters as A


def _run(argv):
    buf = _io.StringIO()
    with redirect_stdout(buf):
        assert cli.main(argv) == 0
    return buf.getvalue().splitlines()


def test_cli_ingest_report_rewrite(spark, sf_small):
    base = tempfile.mkdtemp(prefix="playlog-cli-")
    A.corpus_a_log(spark, sf_small).write.text(os.path.join(base, "log"))
    A.corpus_a_roster_lines(spark, sf_small).select("value").coalesce(1).write.text(os.path.join(base, "roster"))
    roster = [os.path.join(base, "roster", f) for f in os.listdir(os.path.join(base, "roster"))
              if f.startswith("part-")][0]
    log = os.path.join(base, "log")
    events = os.path.join(base, "events")
    _run(["ingest", "--log", log, "--roster", roster, "--out", events])
    top = _run(["report", "top-scorers", "--events", events])
    assert len(top) == 11 and top[0].startswith("1 Supplier, ")
    lead = _run(["report", "season-top-fouler", "--events", events])
    assert lead and all(" Supplier, " in line for line in lead)
    trend = _run(["report", "point-trend", "--events", events])
    # player (two words), season_from, season_to, points_from, points_to, diff, trend text
    diffs = [int(line.split(" ")[6]) for line in trend]
    assert diffs == sorted(diffs, reverse=True) and len(diffs) > 0
    _run(["report", "point-trend", "--events", events, "--out", os.path.join(base, "trend")])
    assert [r["value"] for r in spark.read.text(os.path.join(base, "trend")).collect()] == trend
    every = _run(["report-all", "--events", events, "--out", os.path.join(base, "reports"), "--min-attempts", "10"])
    sections = [line[3:] for line in every if line.startswith("== ")]
    assert sections == ["top_scorers", "season_top_scorer", "shooting_ratio_leaders", "season_top_fouler",
                        "point_trend", "buzzer_beaters", "ratio_trend", "quarter_point_leaders"]
    quarters = every[every.index("== quarter_point_leaders") + 1:]
    assert [q.split()[0] for q in quarters] == sorted(q.split()[0] for q in quarters)
    assert quarters == _run(["report", "quarter-point-leaders", "--events", events])
    assert every[1:12] == top
    audit = dict(line.split() for line in _run(["rewrite", "--log", log, "--roster", roster,
                                                  "--out", os.path.join(base, "clean")]))
    assert set(audit) == {"rewritten", "unmatched", "no_token"}
    counts = dict(line.split() for line in _run(["count", "--text", log, "--needle", "PTS"]))
    assert int(counts["PTS"]) > 0


def test_cli_reports_on_documents(spark, sf_small):
    from playlog.plans import catalog as C

    base = tempfile.mkdtemp(prefix="playlog-cli-docs-")
    C.log_b(spark, sf_small).select("value").write.text(os.path.join(base, "log"))
    A.corpus_b_roster(spark, sf_small).selectExpr("concat_ws('\t', '0', name, true_name, '0', team) AS value") \
        .coalesce(1).write.text(os.path.join(base, "roster"))
    roster = [os.path.join(base, "roster", f) for f in os.listdir(os.path.join(base, "roster"))
              if f.startswith("part-")][0]
    docs = os.path.join(base, "docs")
    _run(["build-matches", "--log", os.path.join(base, "log"), "--roster", roster, "--out", docs,
          "--format", "json", "--id-offset", "6545", "--max-events", "10000"])
    top = _run(["report", "top-scorers", "--documents", docs, "--documents-format", "json", "--n", "3"])
    assert len(top) == 3 and top[0].startswith("1 User, ")
    # a later load continues the ids after the stored ones
    first = spark.read.json(docs).agg({"id_match": "max"}).first()[0]
    _run(["build-matches", "--log", os.path.join(base, "log"), "--roster", roster, "--out", docs,
          "--format", "json", "--continue-ids", "--max-events", "10000"])
    ids = spark.read.json(docs).select("id_match").distinct()
    assert ids.agg({"id_match": "min"}).first()[0] == 6546
    assert ids.agg({"id_match": "max"}).first()[0] == 2 * first - 6545


def test_cli_marks_appends_and_needles(spark, sf_small, tmp_path):
    base = str(tmp_path)
    lines = A.corpus_b_recorded_log(spark, sf_small)
    lines.repartitionByRange(3, "ord").sortWithinPartitions("ord").select("value").write.text(f"{base}/feeds/a")
    roster = A.corpus_b_roster(spark, sf_small).selectExpr(
        "concat_ws('\t', 'x', name, true_name, 'y', team) as value")
    roster.coalesce(1).write.text(f"{base}/roster")
    common = ["--log", f"{base}/feeds/a", "--roster", f"{base}/roster"]
    _run(["build-matches", *common, "--out", f"{base}/m", "--max-events", "100", "--by-marks", "--format", "json-array"])
    from playlog import schemas
    from playlog.sources import json_array

    docs = json_array.read_array(spark, f"{base}/m", schemas.MATCH)
    n = docs.agg({"id_match": "max"}).first()[0]
    twice = docs.where("home = 'T00'").groupBy("game_id").count().where("count <> 2").count()
    assert docs.select("id_match").distinct().count() == n and twice == 0
    top = _run(["report", "top-scorers", "--documents", f"{base}/m", "--documents-format", "json-array"])
    for _ in range(2):  # the second is recognised
        assert _run(["append", *common, "--table", f"{base}/t", "--name", "all", "--by-marks"]) == [
            f"all: matches 1 to {n}"]
    assert _run(["report", "top-scorers", "--table", f"{base}/t"]) == top
    every = _run(["report-all", "--table", f"{base}/t", "--out", f"{base}/r", "--min-attempts", "1"])
    assert every[1:12] == top
    _run(["follow", "--log", f"{base}/feeds", "--roster", f"{base}/roster", "--table", f"{base}/live", "--checkpoint",
          f"{base}/ck", "--max-events", "100000", "--available-now"])
    from playlog.streaming.documents import read_documents

    live = read_documents(spark, f"{base}/live")
    assert live.where("kind = 'match'").count() == n - 1  # the last match is still open
    (tmp_path / "words.txt").write_text("Missed\nTimeout\nnowhere\n")
    counts = _run(["count", "--text", f"{base}/feeds/a", "--needles", f"{base}/words.txt"])
    plain = _run(["count", "--text", f"{base}/feeds/a", "--needle", "Missed", "--needle", "Timeout", "--needle", "nowhere"])
    assert sorted(counts) == sorted(plain)
    similar = _run(["coverage", *common, "--similar", "1"])
    assert similar == []
