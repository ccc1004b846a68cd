import numpy as np

from playlog.llm import graph, simhash
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H


def test_fingerprints_match_plain_version(spark):
    rows = H.odd_texts()
    got = simhash.fingerprints(H.docs(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    want = sorted(H.simhash(t) for _, t in rows)
    assert sorted(r["fp"] & (2 ** 64 - 1) for r in got) == want


def _near(rng, n, flips):
    base = rng.integers(0, 2 ** 63, dtype=np.int64)
    out = [int(base)]
    for _ in range(n):
        x = out[rng.integers(0, len(out))]
        for b in rng.choice(63, flips, replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


def test_links_have_the_components_of_all_pairs(spark):
    rng = np.random.default_rng(3)
    fps = [int(x) for x in rng.integers(0, 2 ** 63, 300, dtype=np.int64)] + [0, 1, 3, -1, -2]
    for _ in range(20):
        fps += _near(rng, 12, int(rng.integers(1, 5)))
    fps += _near(rng, 300, 2)  # one large group
    fps = list(dict.fromkeys(fps))
    want = H.groups([f & (2 ** 64 - 1) for f in fps])
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for bucket in (4096, 8):  # 8: buckets beyond the bound are keyed again
        roots = {r["node"]: r["root"] for r in graph.components(simhash.links(df, bucket=bucket)).collect()}
        label = [roots.get(f, f) for f in fps]
        pairs = {}
        assert all(pairs.setdefault(a, b) == b for a, b in zip(want, label))
        assert len(set(label)) == len(set(want))


def test_groups_and_representatives(spark):
    rows = H.odd_texts()
    found = simhash.near_duplicates(H.docs(spark, rows, clash=True))
    got = found.collect()
    assert len(got) == len(rows)
    fps = [r["fp"] & (2 ** 64 - 1) for r in got]
    first = H.groups(fps)
    least = {}
    for g, r in zip(first, got):
        if r["id"] is not None:
            least[g] = min(least.get(g, r["id"]), r["id"])
    assert [least.get(g) for g in first] == [r["component"] for r in got]
    keep = simhash.representatives(found).collect()
    assert len(keep) == len(set(first))
    assert simhash.near_duplicates(H.empty(spark)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 901)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_query(spark, sf_small):
    got = QUERIES["op2_simhash"](spark, sf_small).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    fps = [H.simhash(text[r["doc_id"]]) for r in got]
    assert [r["fingerprint"] for r in got] == [f"{f:016x}" for f in fps]
    first, least = H.groups(fps), {}
    for g, r in zip(first, got):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert [r["component_id"] for r in got] == [least[g] for g in first]
