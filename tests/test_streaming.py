"""Streaming loader: parsed events and per-game running score across micro-batches."""

import os
import tempfile

from pyspark.sql import functions as F

from playlog.plans import catalog as C
from playlog.sources import adapters as A
from playlog.streaming.live import live_events, live_points, live_running_score, read_log_stream
from tests.conftest import rows


def test_stream_matches_batch(spark, sf_small):
    base = tempfile.mkdtemp(prefix="playlog-stream-")
    src = os.path.join(base, "in")
    lines = C.log_b(spark, sf_small).select("value")
    line_no = F.split("value", "\t").getItem(1).cast("int")
    # three files, each holding a later slice of every game (log order)
    for i, (lo, hi) in enumerate([(1, 3), (4, 8), (9, 10 ** 6)]):
        lines.where(line_no.between(lo, hi)).coalesce(1).write.text(os.path.join(src, f"part{i}"))
    # files are picked up oldest first, one per micro-batch
    roster = A.corpus_b_roster(spark, sf_small)
    ev = live_events(read_log_stream(spark, os.path.join(src, "part*", "*.txt"), max_files_per_trigger=1), roster)
    q1 = live_running_score(ev).writeStream.format("memory").queryName("rs_out").outputMode("append").option(
        "checkpointLocation", os.path.join(base, "ck1")).start()
    q2 = live_points(ev).writeStream.format("memory").queryName("pts_out").outputMode("complete").option(
        "checkpointLocation", os.path.join(base, "ck2")).start()
    q1.processAllAvailable()
    q2.processAllAvailable()
    q1.stop()
    q2.stop()
    got = rows(spark.table("rs_out"), "game_id", "line_no", "score_home", "score_away")
    want = rows(C.events_b(spark, sf_small), "game_id", "line_no", "score_home", "score_away")
    assert got == want
    batch_pts = (C.events_b(spark, sf_small).where("player is not null and type = 'point'")
                 .groupBy("player", "season").agg(F.sum("points").cast("long").alias("points")))
    assert rows(spark.table("pts_out")) == rows(batch_pts)


def test_stream_appends_event_table(spark, sf_small):
    from playlog.streaming.live import write_events_stream

    base = tempfile.mkdtemp(prefix="playlog-sink-")
    src = os.path.join(base, "in")
    C.log_a(spark, sf_small).select("value").write.text(src)
    roster = A.corpus_a_roster(spark, sf_small)
    ev = live_events(read_log_stream(spark, src), roster)
    out = os.path.join(base, "events")
    q = write_events_stream(ev, out, os.path.join(base, "ck"), trigger_once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = C.events_a(spark, sf_small)
    assert got.count() == want.count()
    assert rows(got.groupBy("season", "type").count()) == rows(want.groupBy("season", "type").count())


def test_running_score_state_expires_after_game_day(spark):
    from playlog.operators.parse import parse_log

    base = tempfile.mkdtemp(prefix="playlog-ttl-")
    src = os.path.join(base, "in")
    batches = [
        ["20240101AAABBB\t1\t00:48:00\t[AAA 2-0] X Jump Shot: Made (2 PTS)",
         "20240105CCCDDD\t1\t00:48:00\t[CCC 3-0] Y 3pt Shot: Made (3 PTS)"],
        ["20240105CCCDDD\t2\t00:40:00\t[DDD 2-3] Z Jump Shot: Made (2 PTS)"],
        ["20240105CCCDDD\t3\t00:30:00\t[CCC 5-2] Y Jump Shot: Made (2 PTS)"],
    ]
    for i, lines in enumerate(batches):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(
            os.path.join(src, f"b{i}"))
    ev = parse_log(read_log_stream(spark, os.path.join(src, "b*", "*.txt"), max_files_per_trigger=1))
    q = live_running_score(ev, game_close_delay="1 day").writeStream.format("memory").queryName("ttl_out") \
        .outputMode("append").option("checkpointLocation", os.path.join(base, "ck")).start()
    q.processAllAvailable()
    state_rows = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    # the Jan 1 game closed once the watermark (Jan 5 - 1 day) passed its day; Jan 5 is still open
    assert state_rows == 1
    assert rows(spark.table("ttl_out"), "game_id", "line_no", "score_home", "score_away") == [
        ("20240101AAABBB", 1, 2, 0), ("20240105CCCDDD", 1, 3, 0), ("20240105CCCDDD", 2, 3, 2),
        ("20240105CCCDDD", 3, 5, 2)]
