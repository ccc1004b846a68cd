"""Many needles in one scan (FLT-10, Q-12)."""

import random

import pytest

from playlog.operators import needles as N
from playlog.plans import queries as Q
from tests.conftest import rows

LINES = ["banana", "an", "", None, "nab a ban", "éa日本", "a" * 1000, "x\ty", "an"]


def _lines(spark, lines=LINES):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _plain(lines, needles):
    return sorted((n, sum(x is not None and n in x for x in lines)) for n in set(needles))


def test_counts_as_contains(spark):
    needles = ["a", "an", "ana", "", "é", "日本", "nowhere", "\t", "an"]
    assert rows(N.count_lines(_lines(spark), needles), "needle", "n") == _plain(LINES, needles)
    two = Q.count_lines_containing(_lines(spark), ["a", "an"])
    assert rows(N.count_lines(_lines(spark), ["a", "an"]), "needle", "n") == rows(two, "needle", "n")


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000])
def test_ten_thousand_needles(spark, block_bytes):
    r = random.Random(1)
    needles = sorted({"".join(r.choices("abcde", k=r.randint(1, 7))) for _ in range(14_000)})[:10_000]
    lines = ["".join(r.choices("abcde ", k=r.randint(0, 60))) for _ in range(300)]
    few = needles if block_bytes > 1 << 20 else needles[:400]
    table = spark.createDataFrame([(n,) for n in few] + [(None,)], "word string")
    got = rows(N.count_lines(_lines(spark, lines).repartition(3), table, needle_col="word", block_bytes=block_bytes),
               "needle", "n")
    assert got == _plain(lines, few)


def test_one_scan(spark, tmp_path):
    _lines(spark).write.text(str(tmp_path / "t"))
    plan = N.count_lines(spark.read.text(str(tmp_path / "t")), [str(i) for i in range(10_000)])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 1 and text.count("MapInArrow") == 1


def test_lines_with_needles(spark):
    got = N.with_needles(_lines(spark).selectExpr("*", "1 as needles"), ["an", "a", "", "zz"]).collect()
    assert [(r["value"], r["needles"]) for r in got] == [
        (x, [] if x is None else [""] + [n for n in ("a", "an") if n in x]) for x in LINES]


def test_nothing(spark):
    assert N.count_lines(_lines(spark), []).count() == 0
    assert rows(N.count_lines(_lines(spark, []), ["a", ""]), "needle", "n") == [("", 0), ("a", 0)]
    assert N.with_needles(_lines(spark), []).selectExpr("sum(size(needles))").first()[0] == 0
