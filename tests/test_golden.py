"""Golden rows from FIXTURES.md §2: per-season top 3 by shooting ratio
(makes, misses, ratio to 6 decimals), attempts > 300."""

import pytest

from playlog.operators import metrics as M
from playlog.operators import ranking as R

# FIXTURES.md §2, "Top 3 (makes, misses, ratio)"
GOLDEN = {
    "2006/2007": [("Lee, David", 380, 192, 0.664336), ("Stoudemire, Amare", 1222, 679, 0.642820),
                  ("Moore, Mikki", 547, 323, 0.628736)],
    "2007/2008": [("Stoudemire, Amare", 1337, 694, 0.658296), ("Bynum, Andrew", 271, 144, 0.653012),
                  ("Childress, Josh", 577, 325, 0.639690)],
    "2008/2009": [("Ming, Yao", 1017, 563, 0.643671), ("Stoudemire, Amare", 727, 409, 0.639965),
                  ("Dampier, Erick", 302, 170, 0.639831)],
    "2009/2010": [("Chandler, Tyson", 228, 129, 0.638655), ("Maggette, Corey", 917, 520, 0.638135),
                  ("Hilario, Nene", 752, 444, 0.628763)],
    "2010/2011": [("Chandler, Tyson", 592, 286, 0.674260), ("Hilario, Nene", 737, 413, 0.640870),
                  ("Johnson, Amir", 252, 142, 0.639594)],
    "2011/2012": [("Chandler, Tyson", 458, 212, 0.683582), ("Splitter, Tiago", 334, 184, 0.644788),
                  ("Harden, James", 609, 368, 0.623337)],
}


@pytest.fixture
def metrics(spark):
    recs = []
    for season, top in GOLDEN.items():
        start = int(season[:4])
        for player, makes, misses, _ in top:
            recs.append((player, start, season, makes, misses, 1))
        # below the top 3, an exact 300-attempt row with a higher ratio (excluded: the rule is strict),
        # and a player without a miss (no misses side, excluded)
        recs.append(("Filler, Low", start, season, 400, 400, 1))
        recs.append(("Exactly, Three Hundred", start, season, 290, 10, 1))
        recs.append(("Only, Makes", start, season, 500, 0, 1))
    return spark.createDataFrame(
        recs, "player string, season_start int, season string, makes long, misses long, point_events long")


def test_golden_top3_per_season(metrics):
    ratio = M.metric_view(metrics, "ratio", min_attempts=300)
    top = R.top_n(ratio, "ratio", 3, "season", "first", ["player"]).collect()
    got = {}
    for r in sorted(top, key=lambda r: (r["season"], r["rank"])):
        got.setdefault(r["season"], []).append((r["player"], r["makes"], r["misses"], round(r["ratio"], 6)))
    assert got == GOLDEN


def test_ratio_edge_players(spark):
    """Makes only / misses only / goaltending (point without PTS) plus misses /
    300 and 301 attempts, at the event level (FIXTURES §4)."""
    recs = []

    def add(player, n, typ, made, missed):
        recs.extend([(player, 2006, "2006/2007", typ, made, missed)] * n)

    add("Makes, Only", 400, "point", True, False)
    add("Misses, Only", 400, "generalEvent", False, True)
    add("Goal, Tender", 1, "point", False, False)      # a point event without PTS: makes side with 0
    add("Goal, Tender", 310, "generalEvent", False, True)
    add("Three, Hundred", 150, "point", True, False)
    add("Three, Hundred", 150, "generalEvent", False, True)
    add("Three, Hundred One", 150, "point", True, False)
    add("Three, Hundred One", 151, "generalEvent", False, True)
    ev = spark.createDataFrame(
        recs, "player string, season_start int, season string, type string, is_made boolean, is_missed boolean")
    got = {r["player"]: (r["makes"], r["misses"], r["ratio"]) for r in M.shooting_ratio(ev, 300).collect()}
    assert got == {"Goal, Tender": (0, 310, 0.0), "Three, Hundred One": (150, 151, 150 / 301)}
