"""parse_log, roster joins (JN-4, JN-5, JN-6), rewrite (FN-9, Q-10), lookup_join paths."""

from pyspark.sql import functions as F

from playlog.operators.joins import lookup_join
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players, rewrite_audit, rewrite_log_names, roster_coverage
from playlog.sources.io import parse_roster
from tests.conftest import rows

LOG = [
    "20061031CHIMIA\t1\t00:48:00\tJump Ball",
    "20061031CHIMIA\t2\t00:47:40\t[MIA 2-0] Wade Jump Shot: Made (2 PTS)",
    "20061031CHIMIA\t3\t00:00:09\t[CHI] O. Brien Jump Shot: Missed",
    "20061031CHIMIA\t4\t-00:04:30\t[CHI 3-2] J. Smith 3pt Shot: Made (3 PTS)",
    "20061031CHIMIA\t5\tbad",
    "20061031CHIMIA\t6\t00:30:00\t[MIA] Nobody Foul: Personal (1 PF)",
]
ROSTER = [
    "0\tWade\tWade, Dwyane\tx\tMIA",
    "1\tO.Brien\tO'Brien, Jermaine\tx\tCHI",
    "2\tJ.Smith\tSmith, Joe\tx\tCHI",
    "3\tJ.Smith\tSmith, Josh\tx\tCHI",
]


def _log(spark):
    return spark.createDataFrame([(v,) for v in LOG], "value string")


def _roster(spark):
    lines = spark.createDataFrame([(v, i) for i, v in enumerate(ROSTER)], "value string, i long")
    return parse_roster(lines, ord_col=F.col("i"))


def test_parse_log_fields(spark):
    p = parse_log(_log(spark))
    got = rows(p, "line_no", "type", "team", "name_token", "quarter", "points", "season", "home", "away", "status")
    assert got == [
        (1, "gameDescription", None, None, "1ST", 0, "2006/2007", "CHI", "MIA", "ok"),
        (2, "point", "MIA", "Wade", "1ST", 2, "2006/2007", "CHI", "MIA", "ok"),
        (3, "generalEvent", "CHI", "O.Brien", "4TH", 0, "2006/2007", "CHI", "MIA", "ok"),
        (4, "point", "CHI", "J.Smith", "OT", 3, "2006/2007", "CHI", "MIA", "ok"),
        (5, "gameDescription", None, None, None, 0, "2006/2007", "CHI", "MIA", "malformed"),
        (6, "generalEvent", "MIA", "Nobody", "2ND", 0, "2006/2007", "CHI", "MIA", "ok"),
    ]
    scores = rows(p.where("line_no in (2, 4)"), "line_no", "score_home_token", "score_away_token")
    assert scores == [(2, None, 2), (4, 3, None)]


def test_resolve_last_roster_row_wins(spark):
    ev = resolve_players(parse_log(_log(spark)), _roster(spark))
    got = rows(ev.where("name_token is not null"), "line_no", "player")
    assert got == [(2, "Wade, Dwyane"), (3, "O'Brien, Jermaine"), (4, "Smith, Josh"), (6, None)]


def test_resolve_include_unresolved(spark):
    ev = resolve_players(parse_log(_log(spark)), _roster(spark), include_unresolved=True)
    assert rows(ev.where("line_no = 6"), "player") == [("",)]


def test_shuffled_and_broadcast_joins_agree(spark, no_broadcast):
    """Same rows, types and column order from both physical joins; no job while planning."""
    p = parse_log(_log(spark))
    a = resolve_players(p, _roster(spark))
    got = a.collect()
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
    with no_broadcast():
        b = resolve_players(p, _roster(spark))
        shuffled = b.collect()
        plan = b._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" not in plan and "SinglePartition" not in plan
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert a.schema == b.schema
    assert sorted(map(repr, got)) == sorted(map(repr, shuffled))


def test_lookup_join_compares_keys_as_spark_does(spark, no_broadcast):
    left = spark.createDataFrame([(1, "l"), (2, "m"), (None, "n")], "id int, a string")
    right = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("z", None)], "v string, id double")
    def run():
        out = lookup_join(left, right, ["id"])
        return out.columns, sorted(map(repr, out.collect()))

    want = run()
    with no_broadcast():
        assert run() == want
    assert want[0] == ["id", "a", "v"] and any("v='x'" in r and "id=1," in r for r in want[1])
    assert sum("v=None" in r for r in want[1]) == 2


def test_lookup_join_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    left = spark.range(10).selectExpr("id", "cast(id AS string) AS k")
    lookup_join(left, left.selectExpr("k", "id AS v"), ["k"])
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_lookup_join_null_keys_bypass(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    right = spark.createDataFrame([("a", 10)], "k string, v int")
    got = rows(lookup_join(left, right, ["k"]), "id", "v")
    assert got == [(1, 10), (2, None), (3, None)]


def test_rewrite_default_and_literal(spark):
    p = parse_log(_log(spark))
    d = rewrite_log_names(p, _roster(spark))
    lit = rewrite_log_names(p, _roster(spark), literal_token=True)
    dv = {r["value"] for r in d.collect()}
    lv = {r["value"] for r in lit.collect()}
    # dotted names: the default rewrites the text as written, the literal mode leaves it
    assert "20061031CHIMIA\t3\t00:00:09\t[CHI] O'Brien,Jermaine Jump Shot: Missed" in dv
    assert "20061031CHIMIA\t3\t00:00:09\t[CHI] O. Brien Jump Shot: Missed" in lv
    # duplicate roster rows: one line per match (JN-5)
    assert "20061031CHIMIA\t4\t-00:04:30\t[CHI 3-2] Smith,Joe 3pt Shot: Made (3 PTS)" in dv
    assert "20061031CHIMIA\t4\t-00:04:30\t[CHI 3-2] Smith,Josh 3pt Shot: Made (3 PTS)" in dv
    audit = dict((r["status"], r["n"]) for r in rewrite_audit(d).collect())
    assert audit == {"rewritten": 4, "unmatched": 1, "no_token": 1, "malformed": 1}


def test_rewrite_searches_after_prefix(spark):
    log = spark.createDataFrame([("20061031WADMIA\t2\t00:47:40\t[MIA 2-0] WAD Jump Shot (2 PTS)",)], "value string")
    ro = parse_roster(spark.createDataFrame([("0\tWAD\tWad, E\tx\tMIA",)], "value string"))
    d = rewrite_log_names(parse_log(log), ro).first()["value"]
    lit = rewrite_log_names(parse_log(log), ro, literal_token=True).first()["value"]
    assert d == "20061031WADMIA\t2\t00:47:40\t[MIA 2-0] Wad,E Jump Shot (2 PTS)"
    assert lit.startswith("20061031Wad,EMIA")


def test_roster_coverage_with_fallback(spark):
    log = spark.createDataFrame([("20061031CHIMIA\t3\t00:00:09\t[CHI] o. brien Jump Shot: Missed",),
                                 ("20061031CHIMIA\t2\t00:47:40\t[MIA 2-0] Wade Jump Shot: Made (2 PTS)",)],
                                "value string")
    cov = roster_coverage(parse_log(log), _roster(spark), fallback=True)
    assert rows(cov, "team", "name_token", "matched", "fallback_name", "n") == [
        ("CHI", "o.brien", False, "O'Brien, Jermaine", 1), ("MIA", "Wade", True, None, 1)]


def test_read_roster_last_file_wins(spark):
    import os
    import tempfile

    from playlog.operators.roster import reduce_roster
    from playlog.sources.io import read_roster

    base = tempfile.mkdtemp(prefix="playlog-roster-")
    with open(os.path.join(base, "a.tsv"), "w") as f:
        f.write("0\tWade\tWade, First\tx\tMIA\n")
    with open(os.path.join(base, "b.tsv"), "w") as f:  # larger: packed into an earlier partition
        for i in range(2000):
            f.write(f"{i}\tP{i}\tPlayer, {i}\tx\tBOS\n")
        f.write("0\tWade\tWade, Second\tx\tMIA\n")
    got = reduce_roster(read_roster(spark, base)).where("name = 'Wade'").first()["true_name"]
    assert got == "Wade, Second"


def test_roster_full_names_are_trimmed(spark):
    ro = parse_roster(spark.createDataFrame([("0\tWade\t Wade, Dwyane  \tx\tMIA",)], "value string"))
    assert ro.first()["true_name"] == "Wade, Dwyane"
