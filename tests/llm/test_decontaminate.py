from playlog.llm import decontaminate
from playlog.llm.queries import ORACLE, QUERIES
from tests.llm import helpers as H
from tools.compare import digest, duck

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, ITEM), (2, ITEM), (3, "Short Item"), (4, None), (5, ""), (None, "solo"), (6, "!!! ..."), (7, "solo"),
         (8, "the the the the the the the the the the the the the"), (1, ITEM), (9, "été déjà vu 日本 x y z w v u t")]


def _items(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'c' AS body", "'c' AS class")


def test_matches_plain_version(spark):
    rows = H.odd_texts() + [
        (50, f"before {ITEM} after"), (51, ITEM.upper()), (52, " ".join(ITEM.split()[1:11])),
        (53, " ".join(ITEM.split()[:9])), (54, "a short item, solo; SOLO"), (55, "the " * 30), (56, "short"),
        (57, ITEM.replace(" ", "--") + " " + ITEM), (58, "Été déjà vu 日本 x y z w v u t"),
        (59, "été déjà vu 日本 x y z w v u")]
    got = decontaminate.contamination(H.docs(spark, rows, clash=True), _items(spark)).collect()
    assert len(got) == len(rows)

    def key(i, n_words, spans, items):
        return (i is None, i or 0, n_words, tuple(spans), tuple(items))

    def spans_of(hit):
        out = []
        for p in sorted(hit):
            if out and out[-1][1] == p:
                out[-1][1] = p + 1
            else:
                out.append([p, p + 1])
        return [tuple(x) for x in out]

    want = []
    for i, t in rows:
        n, hit, items = H.contamination(t, ITEMS)
        want.append(key(i, n, spans_of(hit), items))
    have = [key(r["id"], r["n_words"], [(s["start"], s["stop"]) for s in r["spans"]], r["items"]) for r in got]
    assert sorted(have) == sorted(want)
    assert all(r["n_hit"] == sum(s["stop"] - s["start"] for s in r["spans"]) for r in got)


def test_empty_tables(spark):
    docs = H.docs(spark)
    got = decontaminate.contamination(docs, _items(spark, [(1, None)])).collect()
    assert len(got) == docs.count() and all(r["n_hit"] == 0 and r["items"] == [] for r in got)
    assert decontaminate.contamination(H.empty(spark), _items(spark)).count() == 0


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op8_decontamination"](spark, sf_small)
    cur = duck(sf_small).execute(ORACLE["op8_decontamination"])
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(cur.fetchall(), [d[0] for d in cur.description])
