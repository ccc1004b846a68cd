from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from playlog.llm import mih
from playlog.llm.queries import QUERIES


def _plain(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    d[ids == ids[q]] = np.inf
    order = np.lexsort((ids, d))
    return [int(ids[i]) for i in order if np.isfinite(d[i])][:k], d


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'c' AS id", "'c' AS vec")


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 32))
    x = np.concatenate([c + 0.3 * rng.normal(size=(100, 32)) for c in centre]).astype(np.float32)
    df = _table(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)])
    got = mih.neighbours(df, F.col("vec_id") % 20 == 0, bucket=64).collect()
    found, ids, exact = {}, np.arange(len(x)), x.astype(np.float64)
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["distance"])
    hits = 0
    for q in range(0, len(x), 20):
        want, d = _plain(ids, exact, q)
        mine = [found[q][i][0] for i in range(1, 11)]
        assert all(abs(found[q][i][1] - d[found[q][i][0]]) < 1e-12 for i in range(1, 11))
        assert mine == sorted(mine, key=lambda i: (d[i], i))
        hits += len(set(want) & set(mine))
    assert hits >= 0.9 * 10 * 100


def test_every_code_within_the_radius_is_retrieved(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16))
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vec array<double>")
    model = mih.fit(rows, sample=200, target=0.3)
    code = model.of(x)
    near = np.bitwise_count(code[:1] ^ code).sum(axis=1, dtype=int) <= model.radius
    vectors = rows.selectExpr("id AS vec_id", "vec AS embedding")
    got = mih.neighbours(vectors, F.col("vec_id") == 0, k=399, sample=200, target=0.3).collect()
    assert {r["id"] for r in got} >= set(np.flatnonzero(near)) - {0}
    assert len(got) == 399  # the rest by the wider search


def _shares(spark, x, queries=100):
    """(share of the rows that a query's probes retrieve, recall, meetings a row and query), over all rows."""
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vec array<double>")
    model = mih.fit(rows)
    code, every = model.of(x), np.arange(len(x))
    share, met, hit = [], [], []
    for q in range(0, len(x), len(x) // queries):
        times = model.retrieves(code[q:q + 1], code)
        inside = (times > 0) & (np.bitwise_count(code[q:q + 1] ^ code).sum(axis=1, dtype=int) <= model.radius)
        share.append((times > 0).mean())
        met.append(times.mean())
        want, _ = _plain(every, x, q)
        hit.append(inside[want].mean())
    return model, np.mean(share), np.mean(hit), np.mean(met)


def test_index_prunes_clustered_vectors(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 48))
    x = np.concatenate([c + 0.35 * rng.normal(size=(100, 48)) for c in centre])
    model, share, recall, met = _shares(spark, x)
    assert recall >= 0.9 and share < 0.2 and met < 0.3, (model.parts, model.radius, share, recall, met)


def test_uniform_vectors_keep_their_recall(spark):
    """Vectors without clusters: the radius is wide, and most rows are met whatever the cut."""
    x = np.random.default_rng(5).normal(size=(3000, 48))
    model, share, recall, met = _shares(spark, x, 50)
    assert recall >= 0.9 and model.radius > 20


def test_parts_follow_the_radius(spark):
    rng = np.random.default_rng(3)
    code = np.packbits(rng.integers(0, 2, (2000, 64)) > 0, axis=1)
    base = mih.Codes(np.zeros(64), np.eye(64), 0, 8)
    chosen = [mih._cut(mih.replace(base, radius=r), code, 10 ** 7, mih.PARTS) for r in (3, 8, 30)]
    assert chosen[0].parts == 4 and all(c.radius % c.parts == c.parts - 1 for c in chosen)
    assert all(c.near == r // c.parts for c, r in zip(chosen, (3, 8, 30)))


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(0, v), (1, v), (2, v), (3, None), (4, [0.0] * 4), (5, [1.0, None, 3.0, 4.0]), (6, [float("nan")] * 4),
            (7, [float("inf"), 1.0, 1.0, 1.0]), (8, [1.0]), (100, [4.0, 3.0, 2.0, 1.0]), (None, v), (0, v), (9, [2.0] * 4)]
    got = mih.neighbours(_table(spark, rows), F.col("vec_id") % 100 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r["id"])
    assert by == {0: [1, 2, 9, 100], 100: [9, 0, 1, 2]}  # ties to the smaller id, repeated ids once
    assert mih.neighbours(_table(spark, []), F.lit(True)).count() == 0
    assert mih.neighbours(_table(spark, [(0, v)]), F.lit(True)).count() == 0


def test_copies_of_a_near_id_leave_the_other_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 16)).astype(np.float32)
    near = [(1, [float(v) for v in x[0] + 1e-3 * (1 + i // 2) * np.ones(16, np.float32)]) for i in range(20)]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x) if i != 1] + near
    ids = np.array([i for i, _ in rows])
    vec = np.array([v for _, v in rows], np.float32).astype(np.float64)
    d = np.sqrt(((vec - vec[0]) ** 2).sum(axis=1))
    each = {int(i): d[ids == i].min() for i in set(ids.tolist()) - {0}}
    want = sorted(each, key=lambda i: (each[i], i))[:10]
    for target in (1.0, 0.01):  # by the radius; mostly by the wider search
        got = mih.neighbours(_table(spark, rows), F.col("vec_id") == 0, bucket=64, target=target).orderBy("rank").collect()
        assert len(got) == 10 and got[0]["id"] == 1 and abs(got[0]["distance"] - each[1]) < 1e-12
        if target == 1.0:
            assert [r["id"] for r in got] == want
        assert len({r["id"] for r in got}) == 10


def test_top_counts_ids_and_hot_ids_spread():
    query, row, dist = np.zeros(23, int), np.array([7] * 20 + [3, 4, 5]), np.array([0.1] * 20 + [0.2, 0.3, 0.4])
    assert row[mih._top(query, row, dist, 3)].tolist() == [7, 3, 4]
    vec = np.random.default_rng(0).normal(size=(4000, 8)).astype(np.float32).astype(np.float64)
    assert np.bincount(mih._mixed(np.full(4000, 7), vec) % 8).max() < 700


def test_query_recall(spark, sf_small):
    got = QUERIES["op5_mih"](spark, sf_small)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = {int(ids[q]): set(_plain(ids, x, q)[0]) for q in range(len(ids)) if ids[q] % 100 == 0}
    assert found.keys() == want.keys()
    assert sum(len(found[q] & want[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_many_probes_are_written_a_few_at_a_time(spark, monkeypatch):
    """Long substrings of a wide radius, buckets split many times: what a task holds doesn't follow the probes."""
    class Held:
        def __init__(self, value):
            self.get = lambda: value

    x = np.random.default_rng(8).normal(size=(3, 16))
    batch = pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array(x.tolist())], names=["id", "vec"])
    codes = mih.Codes(np.zeros(16), np.tile(np.eye(16), 4), 31, 4)
    split = np.random.default_rng(9).integers(0, 3, (4, 1 << 16))
    rows = spark.createDataFrame([], "id long, vec array<double>")
    run = []
    monkeypatch.setattr(mih.C, "map_arrow", lambda df, fn, out: run.append(fn))
    mih._spread(rows, Held(codes), Held(split), 1)
    mih._spread(rows, Held(codes), Held(np.array([[50_000]])), 1, True)
    near = np.flatnonzero(np.bitwise_count(np.arange(1 << 16)) <= codes.near)
    subs = codes.substrings(codes.of(x))
    want = [split[p, s ^ near].sum() for s in subs for p, s in enumerate(s)]
    for fn, total in zip(run, (sum(want), 3 * 50_000)):
        sizes = [len(c["id"]) for c in fn(batch)]
        assert sum(sizes) == total and max(sizes) <= mih.ENTRIES


def test_a_wide_radius_has_few_probes_in_a_large_table(spark):
    code = np.packbits(np.random.default_rng(3).integers(0, 2, (2000, 64)) > 0, axis=1)
    base = mih.Codes(np.zeros(64), np.eye(64), 29, 8)
    for n in (50_000, 600_000, 5_000_000):
        c = mih._cut(base, code, n, mih.PARTS)
        assert c.parts * sum(comb(c.width, i) for i in range(c.near + 1)) < 1000


def test_within_counts_the_bits_of_a_substring():
    differ = np.random.default_rng(4).integers(0, 256, (3, 5, 8)).astype(np.uint8)
    bits = np.unpackbits(differ, axis=2)
    for parts in (4, 8, 16, 32):
        b = mih._Bucket(mih.Codes(np.zeros(64), np.eye(64), 31, parts), 0, False, 3)
        for p in range(parts):
            w = 64 // parts
            assert (b._within(differ, p) == bits[..., p * w:(p + 1) * w].sum(axis=2)).all()


def test_floats_are_moved_as_floats(spark):
    x = np.random.default_rng(10).normal(size=(50, 8)).astype(np.float32)
    codes = mih.C.Shared(spark, mih.Codes(np.zeros(8), np.tile(np.eye(8), 8), 7, 8))
    salts = mih.C.Shared(spark, np.ones((8, 256), int))
    for kind in ("float", "double"):
        rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], f"id long, vec array<{kind}>")
        entries = mih._spread(rows, codes, salts, 0)
        assert entries.schema["vec"].dataType.simpleString() == f"array<{kind}>"
        assert all(np.array_equal(x[r["id"]], r["vec"]) for r in entries.collect())
