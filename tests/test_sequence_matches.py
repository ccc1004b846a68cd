"""Chunked prefix operators against plain windows; match documents round trip."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from playlog import schemas
from playlog.operators.matches import (
    assign_match_ids, build_matches, flatten_matches, report_summary, running_score)
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players
from playlog.operators.sequence import number_rows, prefix_within
from playlog.sources import io
from playlog.session import scratch_path
from tests.conftest import rows


def _data(spark):
    # three games, 0..59 lines, some values NULL
    return spark.range(0, 180).select(
        (F.col("id") % 3).cast("string").alias("g"),
        (F.floor(F.col("id") / 3) + 1).cast("int").alias("o"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("v"),
    )


def test_prefix_matches_window_with_small_chunks(spark):
    df = _data(spark)
    got = prefix_within(df, ["g"], ["o"], F.floor(F.col("o") / 4), sums={"s": F.col("v")},
                        fills={"f": F.col("v")}, counter="n")
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "o", F.sum(F.coalesce("v", F.lit(0))).over(w).alias("s"),
                    F.last("v", ignorenulls=True).over(w).alias("f"), F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long").alias("n"))
    assert rows(got, "g", "o", "s", "f", "n") == rows(ref, "g", "o", "s", "f", "n")


def test_number_rows_across_range_chunks(spark):
    df = _data(spark).select("g", (F.lit(1000) - F.col("o")).alias("t"))
    got = number_rows(df, ["g"], ["t"], "n", n_chunks=7)
    ref = df.select("g", "t", F.row_number().over(Window.partitionBy("g").orderBy("t")).cast("long").alias("n"))
    assert rows(got, "g", "t", "n") == rows(ref, "g", "t", "n")


LOG = [
    "20070101AAABBB\t1\t00:48:00\tJump Ball",
    "20070101AAABBB\t2\t00:47:00\t[AAA 2-0] P1 Jump Shot: Made (2 PTS)",
    "20070101AAABBB\t3\t00:46:00\t[BBB 3-2] P2 3pt Shot: Made (3 PTS)",
    "20070101AAABBB\t4\t00:45:00\t[AAA] P1 Jump Shot: Missed",
    "20070101AAABBB\t5\t00:44:00\t[AAA 3-3] P1 Free Throw 1 of 1 (1 PTS)",
    "20061101CCCAAA\t1\t00:48:00\tJump Ball",
    "20061101CCCAAA\t2\t00:40:00\t[AAA 1-0] P1 Free Throw 1 of 1 (1 PTS)",
]


def _events(spark):
    log = spark.createDataFrame([(v,) for v in LOG], "value string")
    roster = spark.createDataFrame([("P1", "One, P", "AAA", 1)], "name string, true_name string, team string, ord long")
    return resolve_players(parse_log(log), roster)


def test_running_score_resets_per_game(spark):
    ev = running_score(_events(spark), chunk_lines=2)
    assert rows(ev, "game_id", "line_no", "score_home", "score_away") == [
        ("20061101CCCAAA", 1, 0, 0), ("20061101CCCAAA", 2, 0, 1),
        ("20070101AAABBB", 1, 0, 0), ("20070101AAABBB", 2, 2, 0), ("20070101AAABBB", 3, 2, 3),
        ("20070101AAABBB", 4, 2, 3), ("20070101AAABBB", 5, 3, 3)]


def test_match_ids_follow_date_then_game(spark):
    ids = assign_match_ids(_events(spark), offset=6545)
    assert rows(ids, "game_id", "id_match") == [("20061101CCCAAA", 6546), ("20070101AAABBB", 6547)]


def test_documents_round_trip(spark):
    ev = running_score(_events(spark))
    docs = build_matches(ev, assign_match_ids(ev), max_events=3)
    # the 5-line game is split into parts of at most 3 events
    assert rows(report_summary(docs), "game_id", "part", "n_events") == [
        ("20061101CCCAAA", 0, 2), ("20070101AAABBB", 0, 3), ("20070101AAABBB", 1, 2)]
    path = scratch_path(spark, "test-docs")
    io.write_matches(docs, path, fmt="json", mode="overwrite")
    back = io.read_matches(spark, path, fmt="json")
    assert back.schema == schemas.MATCH
    flat = flatten_matches(back)
    assert rows(flat, "game_id", "idLineEvent", "scoreHome", "scoreAway", "playerName") == rows(
        ev.select("game_id", F.col("line_no").cast("string"), F.col("score_home").cast("int"),
                  F.col("score_away").cast("int"), "player"))


def test_documents_as_json_round_trip(spark):
    from playlog.operators.matches import documents_as_json

    ev = running_score(_events(spark))
    docs = build_matches(ev, assign_match_ids(ev), max_events=10_000)
    js = documents_as_json(docs)
    back = js.select(F.from_json("value", schemas.MATCH).alias("d")).select("d.*")
    assert rows(report_summary(back), "game_id", "n_events") == rows(report_summary(docs), "game_id", "n_events")


def test_events_from_json_text(spark):
    from playlog.operators.matches import events_from_json

    ev = running_score(_events(spark))
    docs = build_matches(ev, assign_match_ids(ev), max_events=10_000)
    flat = docs.select(F.explode("report").alias("e")).select(F.to_json("e").alias("value"))
    back = events_from_json(flat)
    assert back.columns == [f.name for f in schemas.REPORT_EVENT.fields]
    assert rows(back, "idLineEvent", "scoreHome", "scoreAway") == rows(
        ev.select(F.col("line_no").cast("string"), F.col("score_home").cast("int"), F.col("score_away").cast("int")))


def test_prefix_keeps_null_keys_and_null_order(spark):
    df = spark.createDataFrame(
        [("g", 1, 5), ("g", None, 7), ("g", 2, None), (None, 1, 3), (None, 2, 4), ("h", 1, 1)],
        "g string, o int, v int")
    got = prefix_within(df, ["g"], ["o"], F.floor(F.col("o") / 2), sums={"s": F.col("v")}, counter="n")
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "o", F.sum(F.coalesce("v", F.lit(0))).over(w).alias("s"),
                    F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long").alias("n"))
    assert got.count() == 6
    assert rows(got, "g", "o", "s", "n") == rows(ref, "g", "o", "s", "n")


def test_events_from_documents_match_parsed_events(spark):
    from playlog.operators.matches import events_from_documents

    ev = running_score(_events(spark))
    docs = build_matches(ev, assign_match_ids(ev), max_events=2)
    back = events_from_documents(docs)
    cols = ["game_id", "line_no", "type", "points", "season", "quarter", "is_made", "is_missed", "is_buzzer",
            "player", "score_home", "score_away"]
    assert rows(back, *cols) == rows(ev.select(*cols))
