"""parse_log against a plain-Python model of the parsing rules (FN-2..FN-8,
FLT-1..FLT-5) on generated lines: prefixes with and without scores, dotted
names, overtime and garbage clocks, marker words in any order."""

from hypothesis import given, settings
from hypothesis import strategies as st

from playlog.operators.parse import parse_log

TEAMS = ["MIA", "CHI", "BOS"]
WORDS = ["J.", "O.", "Smith", "Wade", "Free", "Throw", "3pt", "Shot:", "Made", "(2", "PTS)", "(1", "Missed",
         "missed", "MISSED", "PF)", "TF)", "Foul:", "Jump", "Ball", "]", "x-y"]


def model(line):
    """Reference semantics, written plainly."""
    f = line.split("\t")
    game_id = f[0]
    entry = f[3] if len(f) > 3 else None
    clock = f[2] if len(f) > 2 else None
    home, away = game_id[8:11], game_id[11:14]
    if "[" not in line:
        typ = "gameDescription"
    elif entry is None:
        typ = None
    else:
        typ = "generalEvent" if len(entry.split("]")[0]) == 4 else "point"
    team = token = text = None
    if entry is not None and "] " in entry:
        parts = entry.split("] ")
        team = parts[0][1:4]
        words = parts[1].split(" ")
        w1 = words[0]
        w2 = words[1] if len(words) > 1 else ""
        token = w1 + w2 if "." in w1 else w1
        text = w1 + " " + w2 if "." in w1 else w1
    sh = sa = None
    if entry is not None:
        head = entry.split("]")[0]
        hw = head.split(" ")
        side = hw[0][1:]
        pair = hw[1] if len(hw) > 1 else ""
        if pair != "":
            first = pair.split("-")[0]
            val = int(first) if first.isdigit() else None
            if side == home:
                sh = val
            elif side == away:
                sa = val

    def num(i):
        if clock is None:
            return None
        c = clock.split(":")
        return int(c[i]) if len(c) > i and c[i].isdigit() else None

    minute, second = num(1), num(2)
    ot = clock is not None and "-00" in clock
    if ot:
        quarter = "OT"
    elif minute is None:
        quarter = None
    elif minute < 12:
        quarter = "4TH"
    elif minute < 24:
        quarter = "3RD"
    elif minute < 36:
        quarter = "2ND"
    elif minute <= 48:
        quarter = "1ST"
    else:
        quarter = None
    e = entry or ""
    pts = 0
    if typ == "point":
        if "Free Throw" in e and "PTS" in e:
            pts = 1
        elif "3pt" in e and "PTS" in e:
            pts = 3
        elif "PTS" in e:
            pts = 2
    made = typ == "point" and "PTS" in e
    missed = typ == "generalEvent" and ("Missed" in e or "missed" in e)
    foul = "PF)" in e
    buzzer = typ == "point" and minute == 0 and second is not None and second <= 12
    return (typ, team, token, text, sh, sa, minute, second, ot, quarter, pts, made, missed, foul, buzzer)


prefix = st.one_of(
    st.just(""),
    st.builds(lambda t: f"[{t}] ", st.sampled_from(TEAMS)),
    st.builds(lambda t, a, b: f"[{t} {a}-{b}] ", st.sampled_from(TEAMS), st.integers(0, 120), st.integers(0, 120)),
    st.builds(lambda t: f"[{t}]", st.sampled_from(TEAMS)),
)
clock = st.one_of(
    st.builds(lambda m, s: f"00:{m:02d}:{s:02d}", st.integers(0, 50), st.integers(0, 59)),
    st.builds(lambda m, s: f"-00:{m:02d}:{s:02d}", st.integers(0, 5), st.integers(0, 59)),
    st.sampled_from(["", "bad", "00:05", "00:xx:10"]),
)
entry = st.builds(lambda p, ws: p + " ".join(ws), prefix, st.lists(st.sampled_from(WORDS), max_size=6))
line = st.one_of(
    st.builds(lambda c, e, n: f"20070101CHIMIA\t{n}\t{c}\t{e}", clock, entry, st.integers(1, 500)),
    st.builds(lambda c, n: f"20070101CHIMIA\t{n}\t{c}", clock, st.integers(1, 500)),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(line, min_size=1, max_size=60))
def test_parse_matches_model(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    cols = ["type", "team", "name_token", "name_text", "score_home_token", "score_away_token", "minute", "second",
            "is_ot", "quarter", "points", "is_made", "is_missed", "is_foul", "is_buzzer"]
    got = [tuple(r) for r in parse_log(df).select(*cols).collect()]
    assert got == [model(v) for v in lines]
