import hashlib

import numpy as np
import pytest

from playlog.llm import suffix_dedup as S
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H


def _check(spark, rows, **kw):
    got = S.repeated(H.docs(spark, rows, clash=True), **kw).collect()
    assert len(got) == len(rows)
    bodies = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), b, gone in zip(rows, bodies, H.repeated(bodies)):
        keep = bytes(x for x, g in zip(b, gone) if not g)
        runs, at = [], 0
        while at < len(gone):
            if gone[at]:
                end = at
                while end < len(gone) and gone[end]:
                    end += 1
                runs.append((at, end))
                at = end
            else:
                at += 1
        want.append((i is None, i or 0, len(b), tuple(runs), keep))
    have = [(r["id"] is None, r["id"] or 0, r["n_bytes"], tuple((s["start"], s["stop"]) for s in r["spans"]),
             bytes(r["kept"])) for r in got]
    assert sorted(have) == sorted(want)


def _random(rng, n):
    return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))


def _planted():
    rng = np.random.default_rng(8)
    a, b = _random(rng, 700), _random(rng, 330)
    rows = [(100, _random(rng, 300) + a + _random(rng, 50)), (101, a), (102, _random(rng, 90) + a[100:460] + _random(rng, 99)),
            (103, b[:199] + "#" + b[199:]), (104, b), (105, b[50:251] + "."), (106, b + b), (107, "ab" * 300),
            (108, _random(rng, 40) + "ab" * 120), (109, a[:200]), (110, a[1:200]), (111, "é" * 150), (112, "x" + "é" * 150)]
    rows += [(200 + i, _random(rng, 250) + a[:260] + _random(rng, 250)) for i in range(30)]
    return [r for r in H.odd_texts() if r[0] != 7] + rows


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_matches_plain_version(spark, batches):
    _check(spark, _planted(), batches=batches)


def test_large_groups_take_the_other_path(spark, monkeypatch):
    # an anchor with many candidates, and one with many entries in one task
    monkeypatch.setattr(S, "MANY", 3)
    rows = S.fingerprints(np.zeros(10, np.uint8), 20)[0]
    assert len(rows) == 0
    _check(spark, _planted(), batches=2)


def test_pieces_cut_long_texts(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 1000)
    body = bytes(np.random.default_rng(1).integers(97, 123, 5000).astype(np.uint8))
    covered = np.zeros(5000 - S.LENGTH + 1, int)
    for piece in S._pieces([b"short", body, body[:300]]):
        assert sum(len(b) for _, _, b in piece) <= 1000 + S.LENGTH
        for doc, at, b in piece:
            assert b == (body if doc == 1 else body[:300])[at:at + len(b)]
            if doc == 1:
                covered[at:at + len(b) - S.LENGTH + 1] += 1
    assert (covered == 1).all()


def test_levels_merge_as_a_binary_counter(spark):
    family = S.SuffixFamily(spark)
    rng = np.random.default_rng(9)
    for i in range(5):
        rows = [(j, _random(rng, 400)) for j in range(3)]
        docs = H.docs(spark, rows).select(*S._identity("doc_id", "text"), S.C.utf8("text").alias("body"))
        family.add(docs)
        assert sorted(family.levels) == [b for b in range(4) if (i + 1) >> b & 1]


def test_empty(spark):
    assert S.repeated(H.empty(spark)).count() == 0
    got = S.repeated(H.docs(spark, [(1, None), (2, "short")])).collect()
    assert sorted((r["n_bytes"], bytes(r["kept"]), r["spans"]) for r in got) == [(0, b"", []), (5, b"short", [])]


def test_query(spark, sf_small):
    got = {r["doc_id"]: r for r in QUERIES["op10_suffix_dedup"](spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    bodies = [r["text"].encode() for r in docs]
    for r, b, gone in zip(docs, bodies, H.repeated(bodies)):
        keep = np.frombuffer(b, np.uint8)[~np.asarray(gone, bool)].tobytes()
        g = got[r["doc_id"]]
        spans = sum(x and not y for x, y in zip(gone, [False, *gone]))
        assert (g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) == (
            len(b), sum(gone), spans, hashlib.sha256(keep).hexdigest())
