"""Build play logs and rosters from the supplied tables (FIXTURES §3).

The engine reads raw tab-separated log lines; these adapters write such lines
from the supplied Parquet tables with column expressions, so the parse →
resolve → aggregate path runs on data whose size grows with the tables.

* Corpus A (seasonal log): ``lineitem ⋈ orders ⋈ supplier ⋈ customer``, one
  event per line item. Line numbers repeat inside a game, so it serves the
  order-insensitive queries.
* Corpus B (ordered log): ``events``, numbered per game by (ts, event_id),
  with running scores. It serves running score and match documents.

Line items and orders join with a sort-merge join on the order key; the
dimension joins are plain equi-joins that Catalyst and AQE broadcast only when
the measured side is under ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.functions.scalars import FIELD_SEP
from playlog.operators.sequence import CHUNK, prefix_within, stable_range_chunks
from playlog.session import table_path

# Fixed values of the corpus A layout (FIXTURES §3.1).
UNRESOLVED_EVERY = 25          # suppliers with key % 25 == 0 are left out of the roster
DOUBLED_EVERY = 10             # suppliers with two lines in the careless roster
MINUTE_SHIFT = 3               # minute = quantity - 3 (negative = overtime)
SECOND_STEP = 5                # second = round(discount * 100) * 5
SCORE_TEXT = "10-8"            # fixed score text in corpus A brackets
# Corpus B layout (FIXTURES §3.2): points per event type.
EVENT_POINTS = {"purchase": 3, "click": 2, "signup": 1, "view": 0, "error": 0}
TEAMS_PER_SIDE = 5
RECORDED_TWICE = "T00"         # home team whose games are in the recorded log twice


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name)).select(*cols)


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def supplier_token(suppkey: Column) -> Column:
    """Even key: ``'J. S<key>'`` (a dotted name); odd: ``'S<key>'``."""
    k = suppkey.cast("string")
    return F.when(suppkey % 2 == 0, F.concat(F.lit("J. S"), k)).otherwise(F.concat(F.lit("S"), k))


def _home_code(nationkey: Column) -> Column:
    return F.concat(F.lit("H"), _pad2(nationkey))


def corpus_a_events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to their order, supplier and customer (only used columns)."""
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_discount", "l_returnflag", "l_linestatus")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    s = _read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    # Line items and orders are both fact tables: a shuffled sort-merge join on
    # the order key, never a broadcast of either (their size grows with the data).
    return li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)


def corpus_a_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus A as raw log lines ``game_id\\tline_no\\tclock\\tentry`` (column ``value``)."""
    j = corpus_a_events_source(spark, sf_dir)
    home = _home_code(F.col("s_nationkey"))
    away = F.concat(F.lit("A"), _pad2(F.col("c_nationkey")))
    game_id = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), home, away)
    mi = F.col("l_quantity").cast("int") - MINUTE_SHIFT
    se = F.round(F.col("l_discount") * 100).cast("int") * SECOND_STEP
    clock = F.when(mi < 0, F.concat(F.lit("-00:"), _pad2(-mi - 1), F.lit(":"), _pad2(se))).otherwise(
        F.concat(F.lit("00:"), _pad2(mi), F.lit(":"), _pad2(se)))
    token = supplier_token(F.col("l_suppkey"))
    line = F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    scored = F.concat(F.lit("["), home, F.lit(" " + SCORE_TEXT + "] "), token)
    plain = F.concat(F.lit("["), home, F.lit("] "), token)
    entry = (
        F.when(flag == "A", F.concat(
            scored,
            F.when(line <= 2, F.lit(" Free Throw 1 of 1 (1 PTS)"))
            .when(line <= 4, F.lit(" 3pt Shot: Made (3 PTS)"))
            .otherwise(F.lit(" Jump Shot: Made (2 PTS)"))))
        .when(flag == "N", F.concat(
            plain,
            F.when(status == "O", F.lit(" Jump Shot: Missed")).otherwise(F.lit(" Free Throw 1 of 2 missed"))))
        .when(status == "F", F.concat(plain, F.lit(" Foul: Shooting (1 PF)")))
        .when(line % 2 == 1, F.lit("Timeout: Regular"))
        .otherwise(F.concat(scored, F.lit(" Goaltending")))
    )
    return j.select(F.concat_ws(FIELD_SEP, game_id, line.cast("string"), clock, entry).alias("value"))


def corpus_a_roster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster as TSV lines: ``key  name  true_name  nation  team``; one per supplier
    except every 25th, which stays unresolved."""
    s = _read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    s = s.where(F.col("s_suppkey") % UNRESOLVED_EVERY != 0)
    name = F.replace(supplier_token(F.col("s_suppkey")), F.lit(" "), F.lit(""))
    true_name = F.replace(F.col("s_name"), F.lit("#"), F.lit(", "))
    return s.select(
        F.concat_ws(FIELD_SEP, F.col("s_suppkey").cast("string"), name, true_name,
                    F.col("s_nationkey").cast("string"), _home_code(F.col("s_nationkey"))).alias("value"),
        F.col("s_suppkey").alias("ord"),
    )


def corpus_a_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlog.sources.io import parse_roster

    lines = corpus_a_roster_lines(spark, sf_dir)
    return parse_roster(lines, ord_col=F.col("ord"))


def corpus_a_messy_roster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus A roster as a careless file: full names with blanks around them, a
    second line with another full name for every tenth supplier, and the
    suppliers that the clean roster leaves out under a differently written name
    (``'j-s<key>'`` for ``'J.S<key>'``). ``ord`` keeps the file order."""
    s = _read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    key = F.col("s_suppkey")
    token = F.replace(supplier_token(key), F.lit(" "), F.lit(""))
    careless = F.when(key % 2 == 0, F.concat(F.lit("j-s"), key.cast("string"))).otherwise(
        F.concat(F.lit("s-"), key.cast("string")))
    name = F.when(key % UNRESOLVED_EVERY == 0, careless).otherwise(token)
    full = F.replace(F.col("s_name"), F.lit("#"), F.lit(", "))
    rows = s.select("s_suppkey", "s_nationkey", name.alias("name"), F.explode(F.when(
        key % DOUBLED_EVERY == 0, F.array(full, F.concat(full, F.lit(" Jr")))).otherwise(F.array(full))).alias("full"))
    again = F.endswith("full", F.lit(" Jr"))
    return rows.select(
        F.concat_ws(FIELD_SEP, F.col("s_suppkey").cast("string"), "name", F.concat(F.lit("  "), "full", F.lit(" ")),
                    F.col("s_nationkey").cast("string"), _home_code(F.col("s_nationkey"))).alias("value"),
        F.struct(again, F.col("s_suppkey")).alias("ord"),
    )


# --- corpus B ---------------------------------------------------------------

def _event_points(event_type: Column) -> Column:
    expr = None
    for name, pts in EVENT_POINTS.items():
        cond = event_type == name
        expr = F.when(cond, F.lit(pts)) if expr is None else expr.when(cond, F.lit(pts))
    return expr.otherwise(F.lit(0))


def corpus_b_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as game lines with line numbers and inclusive running scores per side."""
    ev = _read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    home = F.concat(F.lit("T"), _pad2(F.col("user_id") % TEAMS_PER_SIDE))
    away = F.concat(F.lit("V"), _pad2(F.floor(F.col("user_id") / TEAMS_PER_SIDE) % TEAMS_PER_SIDE))
    side = F.col("event_id") % 2 == 0
    pts = _event_points(F.col("event_type"))
    # the table's columns and the game are what moves; the rest follows from them
    ev = ev.select("event_id", "ts", "user_id", "event_type",
                   F.concat(F.date_format("ts", "yyyyMMdd"), home, away).alias("game_id"))
    order = ["ts", "event_id"]
    chunked = stable_range_chunks(ev, ["game_id"], order)
    scored = prefix_within(
        chunked, ["game_id"], order, F.col(CHUNK),
        sums={
            "score_home": F.when(side, pts).otherwise(F.lit(0)),
            "score_away": F.when(~side, pts).otherwise(F.lit(0)),
        },
        counter="line_no",
    )
    return scored.select("event_id", "ts", "user_id", "event_type", "game_id", home.alias("home"), away.alias("away"),
                         side.alias("home_side"), pts.alias("pts"), "score_home", "score_away", "line_no")


def corpus_b_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus B as raw log lines (column ``value``)."""
    b = corpus_b_scored(spark, sf_dir)
    side = F.col("home_side")
    team = F.when(side, F.col("home")).otherwise(F.col("away"))
    own = F.when(side, F.col("score_home")).otherwise(F.col("score_away"))
    opp = F.when(side, F.col("score_away")).otherwise(F.col("score_home"))
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    pts = F.col("pts")
    clock = F.concat(F.lit("00:"), _pad2(F.col("event_id") % 48), F.lit(":"), _pad2(F.col("event_id") % 60))
    entry = (
        F.when(pts > 0, F.concat(
            F.lit("["), team, F.lit(" "), own.cast("string"), F.lit("-"), opp.cast("string"), F.lit("] "), user,
            F.when(pts == 1, F.lit(" Free Throw 1 of 1 (1 PTS)"))
            .when(pts == 2, F.lit(" Jump Shot: Made (2 PTS)"))
            .otherwise(F.lit(" 3pt Shot: Made (3 PTS)"))))
        .when(F.col("event_type") == "view", F.concat(F.lit("["), team, F.lit("] "), user, F.lit(" Jump Shot: Missed")))
        .otherwise(F.lit("Timeout: Regular"))
    )
    return b.select(F.concat_ws(FIELD_SEP, "game_id", F.col("line_no").cast("string"), clock, entry).alias("value"))


def corpus_b_recorded_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus B as a recorder would write it (columns ``value``, ``ord``): game after
    game, each from its line 1 on, then the games of one home team once more, and
    a heading before them all."""
    b = corpus_b_log(spark, sf_dir).withColumn("f", F.split("value", FIELD_SEP))
    game, line = F.get("f", 0), F.get("f", 1).cast("long")
    again = F.when(F.substring(game, 9, 3) == RECORDED_TWICE, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lines = b.select("value", game.alias("game"), line.alias("line"), F.explode(again).alias("copy")).select(
        "value", F.struct("copy", "game", "line").alias("ord"))
    head = spark.range(1).select(F.lit("recorded log").alias("value"), F.struct(
        F.lit(-1).alias("copy"), F.lit("").alias("game"), F.lit(0).cast("long").alias("line")).alias("ord"))
    return lines.unionByName(head)


def corpus_b_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One roster row per (user, team code) a user plays for: name ``U<id>``,
    true name ``User, <id>``, derived from the distinct users of ``events``."""
    users = _read(spark, sf_dir, "events", "user_id").distinct()
    home = F.concat(F.lit("T"), _pad2(F.col("user_id") % TEAMS_PER_SIDE))
    away = F.concat(F.lit("V"), _pad2(F.floor(F.col("user_id") / TEAMS_PER_SIDE) % TEAMS_PER_SIDE))
    name = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    true_name = F.concat(F.lit("User, "), F.col("user_id").cast("string"))
    return users.select(name.alias("name"), true_name.alias("true_name"),
                        F.explode(F.array(home, away)).alias("team"), F.col("user_id").alias("ord"))
