import zlib

import numpy as np

from playlog.llm import toxicity as X
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H


def _corpus(n=400):
    rng, rows = np.random.default_rng(5), []
    plain = ["river", "tree", "hill", "bird", "song", "field", "stone", "light", "road", "house"]
    for i in range(n):
        sents = [" ".join(rng.choice(plain, 6)) for _ in range(int(rng.integers(1, 30)))]
        y = int(i % 5 == 0)
        if y:
            at = int(rng.integers(0, len(sents)))
            ending = "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 3))
            sents[at] += " " + ("nastyone" if i % 3 == 0 else f"vile{ending}")
        rows.append((i, ". ".join(sents) + ".", y))
    return rows


def test_finds_documents_and_sentences(spark):
    rows = _corpus()
    df = H.docs(spark, [(i, t) for i, t, _ in rows], clash=True)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (1, None)], "doc_id long, toxic int")
    model = X.fit(df, labels)
    got = {r["doc_id"]: r for r in X.score(df, model).collect()}
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["toxic_pred"] == rows[i][2] for i in out)
    for i in out:
        said = got[i]["offending_text"]
        assert bool(said) == bool(rows[i][2]) and all("vile" in s or "nasty" in s for s in said)
    # an unseen ending of a known stem; a long plain text stays clean
    more = H.docs(spark, [(1, "a vileness here"), (2, "river tree hill. " * 3000), (3, None), (4, ""), (5, "...")])
    score = {r["doc_id"]: (r["toxic_score"], r["toxic_pred"]) for r in X.score(more, model).collect()}
    assert score[1][1] == 1 and score[2][1] == 0 and score[3] == score[4] == score[5] == (0.0, 0)


def test_noisy_or(spark):
    model = X.ToxicityModel({"=bad": 3.0, "=worse": 4.0}, -2.0)
    p = lambda z: 1 / (1 + np.exp(-z))
    got = X.score(H.docs(spark, [(1, "Bad day. worse, bad! fine")]), model).first()
    want = 1 - (1 - p(1.0)) * (1 - p(5.0)) * (1 - p(-2.0))
    assert abs(got["toxic_score"] - want) < 1e-12
    assert got["offending_index"] == [0, 1] and got["offending_text"] == ["Bad day", "worse, bad"]


def test_only_rows_that_may_teach_do(spark):
    rows = _corpus(300)
    df = H.docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    taken = {t for t, _ in X.sample(df, labels)}
    assert taken == {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    few = X.sample(df, labels, per_class=10, chars=2000)
    assert sum(len(t) for t, y in few if y == 0) <= 2000 and sum(y for _, y in few) <= 10


def test_sample_is_bounded_by_rows(spark):
    """One id in 30,000 rows, alike or not, brings no more than the bounds say."""
    base = _corpus(300)
    may = next(i for i, _, _ in base if zlib.crc32(str(i).encode()) % 3 != 1 and i % 5)
    labels = spark.createDataFrame([(i, y) for i, _, y in base], "doc_id long, toxic int")
    few = H.docs(spark, [(i, t) for i, t, _ in base])
    for text in ("concat('some text ', id)", "'the same text'"):
        hot = spark.range(30_000).selectExpr(f"{may}L as doc_id", f"{text} as text", "'en' as lang", "'s' as source",
                                             "1L as n_chars")
        got = X.sample(few.unionByName(hot.selectExpr("*").select(*few.columns)), labels, per_class=100, chars=5000)
        for y in (0, 1):
            assert 0 < sum(k == y for _, k in got) <= 100 and sum(len(t) for t, k in got if k == y) <= 5000
        assert len(set(got)) == len(got)
    again = X.sample(few.repartition(7), labels, per_class=100, chars=5000)
    assert sorted(again) == sorted(X.sample(few, labels, per_class=100, chars=5000))


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(H.empty(spark), labels)
    got = X.score(H.docs(spark), model).collect()
    assert len(got) == len(H.odd_texts()) and all(r["toxic_pred"] == 0 and r["toxic_score"] < 1e-6 for r in got)
    assert X.score(H.empty(spark), model).count() == 0


def test_query(spark, sf_small):
    got = QUERIES["op6_toxicity"](spark, sf_small)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    bad = got.filter("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)")
    assert bad.count() == 0
