"""Tables of loads: repeated, failed and competing appends (SET-3, SNK-1), and counts that follow (AGG-2..AGG-7)."""

import os
import re
import signal
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.operators import appends
from playlog.operators import metrics as M
from playlog.operators.ingest import events_table
from playlog.plans import catalog as C
from playlog.sources import adapters as A
from playlog.sources import io
from playlog.sources import loads as L
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def _build(spark, table, values):
    def build(key):
        df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], SCHEMA)
        L.write_part(df, table, "rows", key)
        return len(values)

    return build


def _append(spark, table, name, values, **kw):
    return L.append_load(spark, table, name, "-".join(values), _build(spark, table, values), **kw)


def _rows(spark, table, **kw):
    return rows(L.read_part(spark, table, "rows", SCHEMA, id_col="id", **kw), "id", "v")


def test_append_and_repeat(spark, tmp_path):
    t = f"{tmp_path}/t"
    assert L.current(spark, t) == (0, []) and _rows(spark, t) == []
    first = _append(spark, t, "a", ["x", "y"])
    second = _append(spark, t, "b c/d", ["z"])
    assert (first.first_id, second.first_id) == (0, 2)
    assert _rows(spark, t) == [(1, "x"), (2, "y"), (3, "z")]
    before = L.current(spark, t)
    assert _append(spark, t, "a", ["x", "y"]) == first and L.current(spark, t) == before
    with pytest.raises(L.LoadConflict):
        _append(spark, t, "a", ["other"])
    assert L.current(spark, t) == before and _rows(spark, t, version=1) == [(1, "x"), (2, "y")]
    assert _rows(spark, t, names=["b c/d"]) == [(3, "z")]


def test_replacing_a_load(spark, tmp_path):
    t = f"{tmp_path}/t"
    for name, values in (("a", ["x", "y"]), ("b", ["z"])):
        _append(spark, t, name, values)
    assert _append(spark, t, "a", ["w"], replacing=True).first_id == 0  # the ids it had suffice
    assert _rows(spark, t) == [(1, "w"), (3, "z")]
    assert _append(spark, t, "a", ["w", "u"], replacing=True).first_id == 0  # as many as were reserved
    assert _append(spark, t, "a", ["p", "q", "r"], replacing=True).first_id == 3
    assert _rows(spark, t) == [(3, "z"), (4, "p"), (5, "q"), (6, "r")]
    assert _append(spark, t, "c", ["s"]).first_id == 6
    assert _rows(spark, t, version=2) == [(1, "x"), (2, "y"), (3, "z")]  # an earlier version stays readable
    assert len(L.remove_unlisted(spark, t, "rows")) == 3
    assert len(_rows(spark, t)) == 5


def test_a_failed_build_changes_nothing(spark, tmp_path):
    t = f"{tmp_path}/t"
    _append(spark, t, "a", ["x"])

    def fails(key):
        _build(spark, t, ["half"])(key)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        L.append_load(spark, t, "b", "half", fails)
    assert _rows(spark, t) == [(1, "x")] and L.current(spark, t)[0] == 1
    assert _append(spark, t, "b", ["half"]).first_id == 1
    assert _rows(spark, t) == [(1, "x"), (2, "half")]


def test_two_writers(spark, tmp_path):
    """Another load gets the version while this one is being built, then while it publishes."""
    t = f"{tmp_path}/t"

    def build(key):
        _append(spark, t, "other", ["o1", "o2"])
        return _build(spark, t, ["x"])(key)

    assert L.append_load(spark, t, "a", "x", build).first_id == 2
    assert not L._publish(spark, t, 2, [])  # the version is taken
    assert _rows(spark, t) == [(1, "o1"), (2, "o2"), (3, "x")]

    def twice(key):  # the same load by another attempt
        _append(spark, t, "same", ["s"])
        return _build(spark, t, ["s"])(key)

    L.append_load(spark, t, "same", "s", twice)
    assert [v for _, v in _rows(spark, t)].count("s") == 1
    assert not [n for n in os.listdir(f"{t}/loads") if not re.match(r"\.?\d{12}\.json(\.crc)?$", n)]


def test_killed_between_write_and_publish(spark, tmp_path):
    t, repo = f"{tmp_path}/t", os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    _append(spark, t, "a", ["x"])
    script = textwrap.dedent(f"""
        import os, signal, sys
        sys.path.insert(0, {repo!r})
        from playlog.session import build_session
        from playlog.sources import loads as L
        from tests.test_loads import _append
        spark = build_session("local[2]", shuffle_partitions=2)
        L._publish = lambda *a: os.kill(os.getpid(), signal.SIGKILL)
        _append(spark, {t!r}, "b", ["y", "z"])
    """)
    done = subprocess.run([sys.executable, "-c", script], cwd=repo, capture_output=True, timeout=300)
    assert done.returncode == -signal.SIGKILL
    assert len([n for n in os.listdir(f"{t}/rows") if n.startswith("load=b~")]) == 1  # written, not published
    assert _rows(spark, t) == [(1, "x")] and L.current(spark, t)[0] == 1
    assert _append(spark, t, "b", ["y", "z"]).first_id == 1
    assert _rows(spark, t) == [(1, "x"), (2, "y"), (3, "z")]
    assert len(L.remove_unlisted(spark, t, "rows")) == 1


def test_fingerprint(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "value string")
    same = L.content_fingerprint(df.repartition(3).orderBy(F.desc("value")))
    assert L.content_fingerprint(df) == same
    assert L.content_fingerprint(df.limit(0)) != same != L.content_fingerprint(df.distinct())


def _season(spark, sf_small, early):
    day = F.substring("value", 1, 8)
    return C.log_b(spark, sf_small).where(day < C.MERGE_SPLIT_DATE if early else day >= C.MERGE_SPLIT_DATE)


def test_reports_after_append_equal_a_full_recompute(spark, sf_small, tmp_path):
    t, roster = f"{tmp_path}/t", A.corpus_b_roster(spark, sf_small)
    early, late = _season(spark, sf_small, True), _season(spark, sf_small, False)
    appends.append_log(spark, t, "early", early, roster)
    short = late.where(F.substring("value", 9, 3) != "T00")
    for log, replacing in ((short, False), (late, True), (late, False)):
        appends.append_log(spark, t, "late", log, roster, replacing)
        every = events_table(early.unionByName(log), roster)
        want = M.player_season_metrics(every, by_quarter=True)
        assert rows(appends.report_counts(spark, t, by_quarter=True), *want.columns) == rows(want)
        for kind in ("points", "ratio") if replacing else ():
            got = M.metric_view(appends.report_counts(spark, t), kind, 3)
            assert rows(got) == rows(M.metric_view(M.player_season_metrics(every), kind, 3), *got.columns)
    events = appends.read_events(spark, t)
    assert events.count() == early.count() + late.count()
    games = events.groupBy("game_id").agg(F.countDistinct("id_match").alias("n"), F.min("id_match").alias("i"))
    assert games.where("n > 1").count() == 0
    assert games.select("i").distinct().count() == games.count()


def test_appends_and_reports_read_what_is_new(spark, sf_small, tmp_path):
    """A report reads the loads' counts alone; an append reads no event of an earlier load."""
    t, roster = f"{tmp_path}/t", A.corpus_b_roster(spark, sf_small)
    appends.append_log(spark, t, "early", _season(spark, sf_small, True), roster)
    first = L.current(spark, t)[1][0].key
    for d, _, names in os.walk(f"{t}/events/load={first}"):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(d, n), "r+b") as f:
                    f.truncate(0)  # an event file that is read now would fail
            os.chmod(os.path.join(d, n), 0)
    late = _season(spark, sf_small, False)
    appends.append_log(spark, t, "late", late, roster)
    counts = appends.report_counts(spark, t)
    assert not [p for p in counts.inputFiles() if "/metrics/" not in p]
    every = events_table(C.log_b(spark, sf_small), roster)
    assert rows(counts, *[c for c in M.player_season_metrics(every).columns]) == rows(M.player_season_metrics(every))
    season = counts.select("season").first()[0]
    pruned = appends.report_counts(spark, t, [season])
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()
    assert {r["season"] for r in pruned.collect()} == {season}


def test_matches_by_marks_append_too(spark, tmp_path):
    roster = spark.createDataFrame([("U2", "User, 2", "H00", 1)], "name string, true_name string, team string, ord long")
    t = f"{tmp_path}/t"
    for name, first in (("one", "20200101H00A00"), ("two", "20200102H00A00")):
        (tmp_path / name).mkdir()
        lines = [f"{first}\t{i}\t00:01:00\t[H00 {2 * i}-0] U2 Jump Shot: Made (2 PTS)" for i in (1, 2, 3)] * 2
        (tmp_path / name / "log.txt").write_text("\n".join(lines))
        appends.append_log(spark, t, name, io.read_ordered_log(spark, f"{tmp_path}/{name}"), roster)
    got = appends.read_events(spark, t).orderBy("id_match", "line_no").collect()
    assert [r["id_match"] for r in got] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [r["score_home"] for r in got] == [2, 4, 6] * 4 and {r["player"] for r in got} == {"User, 2"}
    assert rows(M.metric_view(appends.report_counts(spark, t), "points"), "player", "points") == [("User, 2", 24)]


def test_append_moves_lines_not_events(spark, sf_small, tmp_path, monkeypatch):
    """What an append deals by season are the lines with their ids and scores; the events are parsed where they are
    written, and are those of the plain parse and join."""
    plans, write = [], L.write_part
    monkeypatch.setattr(L, "write_part", lambda df, *a: (
        plans.append(df._jdf.queryExecution().optimizedPlan()), write(df, *a))[1])
    odd = spark.createDataFrame([("no tabs",), ("20240101T00V01\tx\t\t[T00] ",)], "value string")
    log, roster = C.log_b(spark, sf_small).unionByName(odd), A.corpus_b_roster(spark, sf_small)
    appends.append_log(spark, f"{tmp_path}/t", "one", log, roster)
    node = plans[0]
    while node.nodeName() != "RebalancePartitions":
        node = node.children().apply(0)
    names = {node.output().apply(i).name() for i in range(node.output().size())}
    assert names == {"value", "player", "season_start", "game_id", "line_no", "score_home", "score_away", "id_match"}
    want = events_table(log, roster)
    got = appends.read_events(spark, f"{tmp_path}/t")
    assert got.count() == want.count() and got.select(want.columns).exceptAll(want).count() == 0
