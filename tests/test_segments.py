"""Matches cut by start marks (AGG-10, WIN-6, WIN-5): against a line-by-line loader."""

import random

import pytest
from pyspark.sql import functions as F

from playlog.operators.parse import parse_log
from playlog.operators.segments import (
    build_marked_matches, log_audit, marked_match_ids, marked_scores, segment_matches)
from playlog.sources import io

KEEP = ("log_split", "log_row")


def _load(lines, carry):
    """What a loader that reads line by line makes of a log: a list of matches."""
    matches, home, away = [], 0, 0
    for line in lines:
        row = line.split("\t")
        number = int(row[1]) if len(row) > 1 and row[1].strip().isdigit() else None
        if number == 1:
            matches.append({"game": row[0], "lines": []})
            if not carry:
                home = away = 0
        entry = row[3] if len(row) > 3 else ""
        head = entry.split("]")[0].split(" ") if entry.startswith("[") else []
        if len(head) == 2 and "-" in head[1]:
            score = int(head[1].split("-")[0])
            if head[0][1:] == row[0][8:11]:
                home = score
            elif head[0][1:] == row[0][11:14]:
                away = score
        if matches:
            matches[-1]["lines"].append((number, entry or None, home, away))
    return matches


def _game(r, date, home, away, n):
    game, sh, sa, out = f"{date}{home}{away}", 0, 0, []
    for i in range(1, n + 1):
        kind = r.random()
        if kind < 0.4:
            side, own = (home, sh := sh + 2) if kind < 0.2 else (away, sa := sa + 3)
            other = sa if side == home else sh
            out.append(f"{game}\t{i}\t00:{i % 48:02d}:00\t[{side} {own}-{other}] U{i} Jump Shot: Made (2 PTS)")
        elif kind < 0.7:
            out.append(f"{game}\t{i}\t00:{i % 48:02d}:00\t[{home}] U{i} Jump Shot: Missed")
        else:
            out.append(f"{game}\t{i}\t00:{i % 48:02d}:00\tTimeout: Regular")
    return out


def _log(seed=1, games=12):
    """Games of 1 to 400 lines; some logged twice, some under another game's id."""
    r = random.Random(seed)
    lines = ["a heading", "", "20200101AAABBB\t7\t00:01:00\tTimeout: Regular"]
    for i in range(games):
        g = _game(r, f"202001{1 + i % 5:02d}", f"H{i % 3:02d}", f"A{i % 2:02d}", r.choice([1, 2, 30, 400]))
        lines += g
        if i % 4 == 0:
            lines += g  # the same game again
        if i % 5 == 0:
            lines += ["broken line", "20200109ZZZYYY\t55\t00:00:01\t[ZZZ 9-0] X Foul: Shooting (1 PF)"]
    return lines


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)


def _read(spark, folder, lines, cuts=()):
    """The log as text files, cut at the given line numbers; names in order."""
    edges = [0, *cuts, len(lines)]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        (folder / f"log-{k:02d}.txt").write_text("".join(x + "\n" for x in lines[a:b]))
    return parse_log(io.read_ordered_log(spark, str(folder)), keep=KEEP).withColumn("player", F.lit(None).cast("string"))


def _documents(docs):
    """Matches by id: game, lines in order."""
    out = {}
    for d in sorted(docs.collect(), key=lambda d: (d["id_match"], d["part"])):
        m = out.setdefault(d["id_match"], {"game": d["game_id"], "lines": []})
        assert d["game_id"] == m["game"] and d["date"] == d["game_id"][:8]
        m["lines"] += [(int(e["idLineEvent"]) if e["idLineEvent"] else None, e["entry"], e["scoreHome"], e["scoreAway"])
                       for e in d["report"]]
    return [out[k] for k in sorted(out)], sorted(out)


@pytest.mark.parametrize("carry, max_events", [(False, 10_000), (True, 7)])
def test_as_a_line_by_line_loader(spark, tmp_path, small_splits, carry, max_events):
    lines = _log()
    events = _read(spark, tmp_path, lines, cuts=(5, 300, 301, 900))
    segmented = segment_matches(events)
    assert segmented.select("log_split").distinct().count() > 12
    spread = segmented.groupBy("match_seq").agg(F.countDistinct("log_split").alias("n")).agg(F.max("n")).first()[0]
    assert spread >= 3  # a match over three splits and more is one
    got, ids = _documents(build_marked_matches(marked_scores(segmented, carry), max_events, offset=100))
    want = _load(lines, carry)
    assert ids == [101 + i for i in range(len(want))]
    assert [m["game"] for m in got] == [m["game"] for m in want]
    for g, w in zip(got, want):
        assert [x[:2] for x in g["lines"]] == [x[:2] for x in w["lines"]]
        assert [x[2:] for x in g["lines"]] == [x[2:] for x in w["lines"]]


def test_numbers_and_audit(spark, tmp_path, small_splits):
    lines = _log(seed=7)
    events = _read(spark, tmp_path, lines, cuts=(40,))
    rows = segment_matches(events).orderBy("log_no").collect()
    assert [r["log_no"] for r in rows] == list(range(1, len(lines) + 1))
    assert [r["value"] for r in rows] == lines
    seq = at = 0
    for r in rows:
        if r["line_no"] == 1:
            seq, at = seq + 1, 0
        at += 1
        assert r["match_seq"] == seq and r["match_line"] == (at if seq else None)
    ids = sorted((r["id_match"], r["game_id"]) for r in marked_match_ids(events, 6545).collect())
    assert ids == [(6545 + r["match_seq"], r["game_id"]) for r in rows if r["line_no"] == 1]
    audit = log_audit(segment_matches(events)).first()
    assert (audit["lines"], audit["matches"], audit["before_first"]) == (len(lines), seq, 3)
    assert audit["mixed"] == len({r["match_seq"] for r in rows if r["match_seq"] and r["game_id"] != r["match_game_id"]}) > 0


def test_same_game_twice_is_two_matches(spark, tmp_path):
    game = _game(random.Random(2), "20200101", "H00", "A00", 20)
    events = _read(spark, tmp_path, game + game)
    got, ids = _documents(build_marked_matches(marked_scores(segment_matches(events)), 100))
    assert ids == [1, 2] and got[0] == got[1] and len(got[0]["lines"]) == 20


def test_no_mark_and_empty_log(spark, tmp_path):
    events = _read(spark, tmp_path, ["x", "20200101AAABBB\t2\t00:00:00\tTimeout"])
    assert build_marked_matches(marked_scores(segment_matches(events)), 10).count() == 0
    assert [r["match_seq"] for r in segment_matches(events).collect()] == [0, 0]
    (tmp_path / "none").mkdir()
    events = _read(spark, tmp_path / "none", [])
    assert segment_matches(events).count() == 0 and marked_match_ids(events).count() == 0


def test_random_logs(spark, tmp_path, small_splits):
    for seed in range(2):
        folder = tmp_path / str(seed)
        folder.mkdir()
        r = random.Random(seed)
        lines = [f"20200101H{r.randint(0, 9):02d}A00\t{r.choice([1, 1, 2, 3, 'x', ''])}\t00:00:00\tTimeout: Regular"
                 for _ in range(600)]
        got, _ = _documents(build_marked_matches(marked_scores(segment_matches(
            _read(spark, folder, lines, cuts=sorted(r.sample(range(600), 4))))), 50))
        assert [(m["game"], len(m["lines"])) for m in got] == [
            (m["game"], len(m["lines"])) for m in _load(lines, False)]


def test_lines_stay_in_their_split(spark, tmp_path):
    """Lines are dealt by split alone; the only window without a key is over one row a split."""
    events = _read(spark, tmp_path, _log())
    plan = segment_matches(events)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window" in x]
    unkeyed = [x for x in windows if "log_split" not in x.split("windowspecdefinition(")[1].split(" ASC")[0]]
    assert windows and all("_pl_lines" in x or "_pl_marks" in x or "_pl_placed" in x for x in unkeyed)
