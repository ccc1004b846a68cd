"""One top-level JSON array: read in splits, written by several tasks (SRC-1, SNK-2)."""

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from playlog import schemas
from playlog.sources import json_array as J
from tests.conftest import rows

NASTY = ["}", "],", "}]", "{", "[", '"', '\\"', "\\", "\\\\", '"}],[{"', "a}b{c", "é日本🙂", "\n}\t", "]", ",", "",
         '\\\\"}', "{}", "[]", '\\u007d']


def _documents(n=80, seed=1):
    r = random.Random(seed)
    return [{"id": i, "text": "".join(r.choices(NASTY, k=r.randint(0, 6))),
             "report": [{"entry": r.choice(NASTY), "n": r.choice([None, 1, -2.5, True]), "more": {"x": [[], {}, [1, {"y": {}}]]}}
                        for _ in range(r.randint(0, 5))]} for i in range(n)]


@pytest.fixture
def splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def _texts(spark, path):
    got = sorted((r["no"], json.loads(r["value"])) for r in J.read_texts(spark, str(path)).collect())
    assert [n for n, _ in got] == list(range(len(got)))
    return [d for _, d in got]


@pytest.mark.parametrize("layout", [dict(indent=2), dict(separators=(",", ":"), ensure_ascii=False)])
def test_one_file_in_many_splits(spark, tmp_path, splits, layout):
    docs = _documents()
    (tmp_path / "a.json").write_text(json.dumps(docs, **layout), encoding="utf-8")
    for size in (211, 1 << 20):
        splits(size)
        assert _texts(spark, tmp_path / "a.json") == docs
    splits(211)
    assert J._pieces(spark, str(tmp_path / "a.json")).select("split").distinct().count() > 50


def test_a_document_over_many_splits(spark, tmp_path, splits):
    docs = [{"a": 1}, {"long": [{"k": "}" * 40, "i": i} for i in range(100)]}, {"b": "]}"}]
    (tmp_path / "a.json").write_text(" \n[ " + " ,\n".join(map(json.dumps, docs)) + "\n ]\n\n")
    splits(50)
    assert _texts(spark, tmp_path / "a.json") == docs


def test_empty_arrays(spark, tmp_path):
    for i, text in enumerate(("[]", "[ ]\n", " [\n]")):
        (tmp_path / f"{i}.json").write_text(text)
        assert J.read_texts(spark, str(tmp_path / f"{i}.json")).count() == 0


@pytest.mark.parametrize("text", ['[{"a": 1}, {"b": ', '[{"a": "}', '{"a": {"b": 1}}', '[1, {"a": 2}]', '[[{"a": 2}]]',
                                  '[{"a": [{"b": 2}'])
def test_what_is_no_array_of_objects(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no array of JSON objects|cut off"):
        J.read_texts(spark, str(tmp_path / "a.json")).collect()


def test_round_trip_of_match_documents(spark, tmp_path, splits):
    event = ("point", "1", "H00", "A00", "00:00:01", 'a "}" ],[ {', 2, 0, "User, 1")
    docs = spark.createDataFrame(
        [(i, f"g{i}", p, "20200101", "H00", "A00", [event] * (i % 4)) for i in range(60) for p in (0, 1)], schemas.MATCH)
    path = str(tmp_path / "out")
    J.write_array(docs, path, ["id_match", "part"], files=5)
    names = sorted(glob.glob(f"{path}/part-*"))
    assert len(names) == 5
    whole = json.loads("".join(open(n, encoding="utf-8").read() for n in names))
    assert [(d["id_match"], d["part"]) for d in whole] == [(i, p) for i in range(60) for p in (0, 1)]
    splits(300)
    got = J.read_array(spark, path, schemas.MATCH)
    assert rows(got.withColumn("report", F.to_json("report"))) == rows(docs.withColumn("report", F.to_json("report")))
    J.write_array(docs.limit(0), path, ["id_match"])
    assert "".join(open(n).read() for n in glob.glob(f"{path}/part-*")).strip() == "[]"
    assert J.read_array(spark, path, schemas.MATCH).count() == 0


def test_structure_is_summed_without_the_texts(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(_documents(5)))
    plan = J.read_texts(spark, str(tmp_path / "a.json"))._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and not any("value#" in x for x in windows) and "Python" not in plan and "Arrow" not in plan
