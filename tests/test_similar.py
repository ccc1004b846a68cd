"""Approximate names (JN-6) against all pairs."""

import random

from pyspark.sql import functions as F

from playlog.operators.similar import LETTERS_AN_EDIT, remainders, similar_names

ROSTER = "name string, true_name string, team string, ord long"


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def _plain(pairs, roster, most):
    names = {}
    for name, true_name, team, o in sorted(roster, key=lambda r: r[3]):
        names[name, team] = true_name
    out = []
    for team, token in sorted({p for p in pairs if p[0] and p[1]}):
        near = {}
        for (name, t), true_name in names.items():
            d = _distance(token, name) if t == team and name and true_name else 99
            if d <= min(most, len(token) // LETTERS_AN_EDIT):
                near.setdefault(d, set()).add(true_name)
        found = sorted(near[min(near)]) if near else []
        out.append((team, token, min(near, default=None), len(found), found[0] if len(found) == 1 else None, found))
    return out


def _got(spark, pairs, roster, most=2):
    df = similar_names(spark.createDataFrame(pairs, "team string, name_token string"), spark.createDataFrame(roster, ROSTER),
                       most)
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_equals_all_pairs(spark):
    r = random.Random(3)
    alphabet = "abcdé."
    names = ["".join(r.choices(alphabet, k=r.randint(0, 9))) for _ in range(160)]
    roster = [(n, r.choice(["", f"True {i % 60}"]) if i % 9 == 0 else f"True {i % 60}", r.choice("XY"), i)
              for i, n in enumerate(names)]
    tokens = names[:40] + ["".join(r.choices(alphabet, k=r.randint(0, 10))) for _ in range(150)]
    pairs = [(r.choice("XYZ"), t) for t in tokens] + [(None, "abc"), ("X", None), ("X", "")]
    for most in (0, 1, 2):
        assert _got(spark, pairs, roster, most) == _plain(pairs, roster, most)


def test_ties_and_last_roster_row(spark):
    roster = [("J.Smith", "Smith, John", "H00", 1), ("J.Smyth", "Smyth, Jane", "H00", 2), ("J.Smith", "Smith, Jim", "H00", 3)]
    got = _got(spark, [("H00", "J.Smjth"), ("H00", "J.Smithe"), ("H01", "J.Smith"), ("H00", "J.Smith")], roster)
    assert got == [("H00", "J.Smith", 0, 1, "Smith, Jim", ["Smith, Jim"]),
                   ("H00", "J.Smithe", 1, 1, "Smith, Jim", ["Smith, Jim"]),
                   ("H00", "J.Smjth", 1, 2, None, ["Smith, Jim", "Smyth, Jane"]),
                   ("H01", "J.Smith", None, 0, None, [])]


def test_remainders(spark):
    df = spark.createDataFrame([("abca",), ("aa",), ("",)], "n string")
    got = [set(r[0]) for r in df.select(remainders(F.col("n"), F.lit(2), 2)).collect()]
    assert got[0] == {"abca", "bca", "aca", "aba", "abc", "ca", "ba", "bc", "aa", "ac", "ab"} and len(got[1]) == 3
    assert got[2] == {""}


def test_no_nested_loop(spark):
    pairs = spark.createDataFrame([("X", "abc")], "team string, name_token string")
    plan = similar_names(pairs, spark.createDataFrame([("abc", "t", "X", 1)], ROSTER))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
