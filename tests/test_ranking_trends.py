"""top_n tie policies (WIN-1..3, AGG-8, AGG-12) and consecutive-period trends (JN-2/3, AGG-13)."""

import pytest

from playlog.operators import ranking as R
from playlog.operators import trends as T
from tests.conftest import rows

DATA = [("s1", "a", 10), ("s1", "b", 10), ("s1", "c", 7), ("s1", "d", 5), ("s2", "a", 3), ("s2", "e", 3)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, "season string, player string, points long")


def test_first(df):
    assert rows(R.top_n(df, "points", 2, "season", "first", ["player"]), "season", "rank", "player") == [
        ("s1", 1, "a"), ("s1", 2, "b"), ("s2", 1, "a"), ("s2", 2, "e")]


def test_all_keeps_ties(df):
    assert rows(R.top_n(df, "points", 1, "season", "all", ["player"]), "season", "rank", "player") == [
        ("s1", 1, "a"), ("s1", 1, "b"), ("s2", 1, "a"), ("s2", 1, "e")]


def test_dense(df):
    assert rows(R.top_n(df, "points", 2, "season", "dense", ["player"]), "season", "rank", "player") == [
        ("s1", 1, "a"), ("s1", 1, "b"), ("s1", 2, "c"), ("s2", 1, "a"), ("s2", 1, "e")]


def test_collapse_subset_of_all(df):
    col = rows(R.top_n(df, "points", 3, "season", "collapse", ["player"]), "season", "player", "points")
    assert col == [("s1", "a", 10), ("s1", "c", 7), ("s1", "d", 5), ("s2", "a", 3)]
    # one representative per distinct value: a subset of the top n distinct values
    dense = rows(R.top_n(df, "points", 3, "season", "dense", ["player"]), "season", "player", "points")
    assert set(col) <= set(dense)


def test_global_top(df):
    assert rows(R.top_overall(df, "points", 3, ["player", "season"]), "rank", "player", "season") == [
        (1, "a", "s1"), (2, "b", "s1"), (3, "c", "s1")]


def test_leader_per(df):
    assert rows(R.leader_per(df, "points", "season"), "season", "player") == [
        ("s1", "a"), ("s1", "b"), ("s2", "a"), ("s2", "e")]


def test_window_group_limit_in_plan(df):
    plan = R.top_n(df, "points", 3, "season", "first", ["player"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_consecutive_diff_skips_gaps(spark):
    df = spark.createDataFrame([("p", 2006, 10), ("p", 2007, 15), ("p", 2009, 4), ("q", 2008, 1)],
                               "player string, s int, v long")
    got = rows(T.consecutive_diff(df, "player", "s", "v"))
    assert got == [("p", 2006, 2007, 10, 15, 5)]
    assert rows(T.consecutive_join(df, "player", "s", "v")) == [("p", 2006, 2007, 10, 15, 5)]


def test_chain_and_periods(spark):
    df = spark.createDataFrame([("p", 2006, 0.5), ("p", 2007, 0.6), ("p", 2008, 0.4), ("p", 2010, 0.9)],
                               "player string, s int, r double")
    pairs = T.consecutive_diff(df, "player", "s", "r")
    per = T.periods_in_pairs(pairs, "player", "s_from", "s_to", "r_from", "r_to", "s", "r")
    ch = T.chain(per, "player", "s", "r").first()
    assert [(e["s"], e["r"]) for e in ch["chain"]] == [(2006, 0.5), (2007, 0.6), (2008, 0.4)]


def test_periods_with_neighbour(spark):
    df = spark.createDataFrame([("p", 2006, 0.5), ("p", 2007, 0.6), ("p", 2008, 0.4), ("p", 2010, 0.9),
                                ("q", 2001, 0.1)], "player string, s int, r double")
    assert rows(T.periods_with_neighbour(df, "player", "s"), "player", "s") == [("p", 2006), ("p", 2007), ("p", 2008)]


def test_format_rows_printable(df):
    from playlog.sources.io import format_rows

    top = R.top_overall(df, "points", 2, ["player", "season"])
    lines = [r["line"] for r in format_rows(top, "%d %s %s %d", "rank", "player", "season", "points")
             .orderBy("rank").collect()]
    assert lines == ["1 a s1 10", "2 b s1 10"]


def test_collapse_across_partitions_drops_shared_totals(spark):
    # s2's leader (10) has the same total as a row of s1: a value-keyed map over
    # all seasons keeps one of them, so s2 falls back to its next row
    df = spark.createDataFrame([("s1", "a", 10), ("s1", "b", 4), ("s2", "z", 10), ("s2", "y", 6)],
                               "season string, player string, points long")
    got = rows(R.leader_per(df, "points", "season", "collapse", ["player"], collapse_by=[]), "season", "player")
    assert got == [("s1", "a"), ("s2", "y")]
    per_season = rows(R.leader_per(df, "points", "season", "collapse", ["player"]), "season", "player")
    assert per_season == [("s1", "a"), ("s2", "z")]
