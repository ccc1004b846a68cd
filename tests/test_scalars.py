"""FN-1..FN-9 and FLT-1..FLT-5 on boundary rows (FIXTURES §4)."""

from pyspark.sql import functions as F

from playlog.functions import scalars as S


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ",".join(f"{n} string" for n in names))
    return df.select(expr.alias("x")).first()["x"]


def test_season_boundaries(spark):
    dates = ["20070731", "20070801", "20070115", "20061231", "bad", "2006XX12", "20061312"]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    got = [tuple(r) for r in df.select(S.season_start("d"), S.season_label(S.season_start("d"))).collect()]
    assert got == [(2006, "2006/2007"), (2007, "2007/2008"), (2006, "2006/2007"), (2006, "2006/2007"),
                   (None, None), (None, None), (None, None)]


def test_quarter_boundaries(spark):
    clocks = ["00:00:05", "00:11:59", "00:12:00", "00:23:00", "00:24:00", "00:35:00", "00:36:00", "00:48:00",
              "00:49:00", "-00:00:07", "-00:04:30", "", "00", "xx:yy:zz"]
    df = spark.createDataFrame([(c,) for c in clocks], "t string")
    got = [r[0] for r in df.select(S.quarter("t")).collect()]
    assert got == ["4TH", "4TH", "3RD", "3RD", "2ND", "2ND", "1ST", "1ST", None, "OT", "OT", None, None, None]


def test_clock_parts(spark):
    df = spark.createDataFrame([("00:47:40",), ("-00:00:07",), ("00:05",), ("",)], "t string")
    got = [tuple(r) for r in df.select(S.clock_minute("t"), S.clock_second("t"), S.is_overtime("t")).collect()]
    assert got == [(47, 40, False), (0, 7, True), (5, None, False), (None, None, False)]


def test_point_value_order(spark):
    entries = ["[MIA 2-0] X Free Throw 1 of 2 (1 PTS)", "[MIA 5-0] X 3pt Shot: Made (3 PTS)",
               "[MIA 7-0] X Jump Shot: Made (2 PTS)", "[MIA 7-0] X Goaltending",
               "[MIA 8-0] X Free Throw 3pt (9 PTS)"]
    df = spark.createDataFrame([(e,) for e in entries], "e string")
    assert [r[0] for r in df.select(S.point_value("e")).collect()] == [1, 3, 2, 0, 1]


def test_missed_is_case_sensitive(spark):
    rows = [("generalEvent", "[MIA] X Jump Shot: Missed"), ("generalEvent", "[MIA] X Free Throw 1 of 2 missed"),
            ("generalEvent", "[MIA] X Jump Shot: MISSED"), ("point", "[MIA 2-0] X Missed tip (2 PTS)")]
    df = spark.createDataFrame(rows, "t string, e string")
    assert [r[0] for r in df.select(S.is_missed("t", "e")).collect()] == [True, True, False, False]


def test_foul_and_made(spark):
    rows = [("generalEvent", "[MIA] X Foul: Shooting (1 PF)"), ("generalEvent", "[MIA] X Foul: Technical (1 TF)"),
            ("point", None), ("point", "[MIA 2-0] X Layup (2 PTS)")]
    df = spark.createDataFrame(rows, "t string, e string")
    got = [tuple(r) for r in df.select(S.is_foul("e"), S.is_made("t", "e")).collect()]
    assert got == [(True, False), (False, False), (False, False), (False, True)]


def test_event_type(spark):
    rows = [("g\t1\t00:48:00\tJump Ball", "Jump Ball"), ("g\t2\t00:47:00\t[MIA] X Missed", "[MIA] X Missed"),
            ("g\t3\t00:47:00\t[MIA 2-0] X (2 PTS)", "[MIA 2-0] X (2 PTS)")]
    df = spark.createDataFrame(rows, "line string, e string")
    assert [r[0] for r in df.select(S.event_type("line", "e")).collect()] == [
        "gameDescription", "generalEvent", "point"]


def test_team_and_tokens(spark):
    rows = ["[CHI] O. Brien Jump Shot: Missed", "[MIA 2-0] Wade Jump Shot: Made (2 PTS)", "Timeout: Regular",
            "[MIA] MIA Foul (1 PF)", "[CHI] J."]
    df = spark.createDataFrame([(r,) for r in rows], "e string")
    got = [tuple(r) for r in df.select(S.event_team("e"), S.name_token("e"), S.name_text("e")).collect()]
    assert got == [("CHI", "O.Brien", "O. Brien"), ("MIA", "Wade", "Wade"), (None, None, None),
                   ("MIA", "MIA", "MIA"), ("CHI", "J.", "J. ")]


def test_score_tokens(spark):
    rows = [("[MIA 2-0] Wade (2 PTS)", "MIA"), ("[MIA 2-0] Wade (2 PTS)", "CHI"), ("[MIA] Wade Missed", "MIA"),
            ("Timeout: Regular", "MIA"), ("[MIA x-0] Wade", "MIA")]
    df = spark.createDataFrame(rows, "e string, side string")
    assert [r[0] for r in df.select(S.score_for("e", "side")).collect()] == [2, None, None, None, None]


def test_buzzer(spark):
    rows = [("point", "00:00:12", "[A 2-0] X Jump Shot (2 PTS)"), ("point", "00:00:13", "[A 2-0] X (2 PTS)"),
            ("point", "-00:00:07", "[A 2-0] X 3pt (3 PTS)"), ("point", "00:00:03", "[A 1-0] X Free Throw (1 PTS)"),
            ("generalEvent", "00:00:03", "[A] X Missed"), ("point", "00:01:05", "[A 2-0] X (2 PTS)")]
    df = spark.createDataFrame(rows, "t string, c string, e string")
    got = [tuple(r) for r in df.select(S.is_buzzer_time("t", "c"), S.buzzer_value("e"),
                                         S.is_buzzer_time("t", "c", include_overtime=False)).collect()]
    assert got == [(True, 1, True), (False, 1, False), (True, 1, False), (True, 0, True), (False, 0, False),
                   (False, 1, False)]


def test_replace_first_literal(spark):
    rows = [("a.b a.b x", "a.b", "Q"), ("no match", "zz", "Q"), ("S1 S1", "S1", "Long Name"), ("abc", "", "Q")]
    df = spark.createDataFrame(rows, "t string, s string, r string")
    assert [r[0] for r in df.select(S.replace_first("t", "s", "r")).collect()] == [
        "Q a.b x", "no match", "Long Name S1", "abc"]
    df2 = spark.createDataFrame([("S1 [X] S1 end",)], "t string")
    assert df2.select(S.replace_first("t", F.lit("S1"), F.lit("Z"), 5)).first()[0] == "S1 [X] Z end"


def test_remove_first_space_and_keys(spark):
    df = spark.createDataFrame([("Wade, Dwyane Tyrone", "2006/2007", 12)], "p string, s string, n int")
    got = df.select(S.remove_first_space("p"), S.legacy_key("p", "s", "n").alias("k")).first()
    assert got[0] == "Wade,Dwyane Tyrone"
    assert got[1] == "Wade, Dwyane Tyrone 2006/2007 12"
    k = df.select(S.legacy_key("p", "s", "n").alias("k"))
    back = k.select(S.legacy_key_body("k").alias("b"), S.legacy_key_value("k").alias("v"))
    back = back.select(S.legacy_key_body("b"), S.legacy_key_value("b"), "v").first()
    assert tuple(back) == ("Wade, Dwyane Tyrone", "2006/2007", "12")


def test_trend_text(spark):
    df = spark.createDataFrame([(-3, "Lee, David", "2006/2007", "2007/2008")], "d int, p string, a string, b string")
    assert df.select(S.trend_text("d", "p", "a", "b")).first()[0] == "-3 Lee, David between 2006/2007 and 2007/2008"
