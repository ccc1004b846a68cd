import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from playlog.llm import periodic
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H


def _plain(ws, least=6, times=4):
    """(start, length, period) of all runs, every period tried at every place."""
    found = {}
    n = len(ws)
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and ws[e] == ws[e + q]:
                e += 1
            if e - s + q >= max(least, times * q):
                found.setdefault((s, e + q), q)  # the smallest period of a stretch comes first
            s = e + 1 if e == s else e
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _collapse(ws, runs):
    out = set()
    for s, n, q in runs:
        out |= set(range(s + q, s + n))
    return " ".join(w for i, w in enumerate(ws) if i not in out)


def _split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _texts(seed=3, n=120):
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        vocabulary = [chr(97 + i) * (1 + i % 3) for i in range(r.choice([1, 2, 3, 8, 40]))]
        parts = []
        for _ in range(r.randint(0, 6)):
            unit = r.choices(vocabulary, k=r.randint(1, r.choice([3, 12, 60])))
            parts += unit * r.choice([1, 1, 3, 4, 5, 9]) + unit[:r.randint(0, len(unit))]
            parts += r.choices(vocabulary, k=r.randint(0, 9))
        texts.append(" ".join(parts))
    return texts


def _check(spark, rows, clash=False, **kw):
    got = periodic.find_runs(H.docs(spark, rows, clash=clash), **kw).collect()
    assert len(got) == len(rows)
    have = sorted(((r["id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got), key=repr)
    want = []
    for i, t in rows:
        ws = _split(t)
        runs = _plain(ws)
        want.append((i, len(ws), tuple(runs), _collapse(ws, runs)))
    assert have == sorted(want, key=repr)
    return have


def test_odd_rows(spark):
    rows = [(i, t if t is None or len(t) < 20_000 else " ".join(t.split()[:1500])) for i, t in H.odd_texts()]
    rows += [(20, "ha " * 6), (21, "ha " * 5), (22, "a b " * 4), (23, "a b " * 3 + "a"), (24, "x " * 700),
             (25, "tick tock\n" * 300 + "end"), (20, "ha " * 6), (None, "la la la la la la la"), (26, "é è " * 9)]
    have = _check(spark, rows, clash=True)
    assert (20, 6, ((0, 6, 1),), "ha") in have and (21, 5, (), "ha ha ha ha ha") in have


@pytest.mark.parametrize("tile_words", [1 << 16, 64, 200])
def test_random_texts(spark, tile_words):
    """Whole in the task that reads them, and cut into pieces."""
    _check(spark, list(enumerate(_texts(n=150))), tile_words=tile_words)


def test_long_periods_across_pieces(spark):
    r = random.Random(9)
    noise = [f"w{r.randint(0, 400)}" for _ in range(3000)]
    rows = [(1, " ".join(noise[:500] * 5)), (2, " ".join(noise[:777] + noise[:130] * 9 + noise[777:900])),
            (3, " ".join(noise)), (4, " ".join((noise[:90] * 4 + ["x"]) * 5)), (5, "b " * 1500)]
    for tile_words in (1 << 16, 128):
        have = _check(spark, rows, tile_words=tile_words)
        assert {len(x[2]) for x in have if x[0] in (1, 2, 5)} == {1}


def test_copies_share_no_stretch(spark):
    """Copies that lie side by side in a batch aren't periodic together."""
    _check(spark, [(i, H.PROSE) for i in range(300)] + [(900 + i, "one two three four five six") for i in range(40)])


def test_fragments_of_a_long_run_are_many_but_merge():
    codes = np.asarray([1, 2, 3, 4] * 500, np.int32)
    found = periodic.solve(codes, np.asarray([0, 2000]), 4)[0]
    assert [f for f in found if f[0] == 4] == [(4, 0, 1996)] and all(q % 4 == 0 for q, _, _ in found)


def test_z_function():
    r = random.Random(1)
    for _ in range(200):
        s = [r.randint(0, 2) for _ in range(r.randint(0, 30))]
        z = periodic.z_function(s)
        for i in range(len(s)):
            n = 0
            while i + n < len(s) and s[n] == s[i + n]:
                n += 1
            assert z[i] == n


def test_empty_table_and_bad_setting(spark):
    assert periodic.find_runs(H.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(H.empty(spark), times=3)


def test_query_matches_plain_version(spark, tmp_path):
    rows = H.odd_texts()[:6] + [(i, " ".join(f"w{i * j % 97}" for j in range(i % 60))) for i in range(400, 700)]
    H.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    want, planted = [], 0
    for i, t in rows:
        ws = _split(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len(ws)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if j < a else ws[a + (j - a) % p] for j, w in enumerate(ws)]
            planted += 1
        runs = _plain(ws)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        want.append((i, len(runs), best and best[1], best and -best[0], best and best[2],
                     best and 1000 * -best[0] // best[2],
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(_collapse(ws, runs).encode()).hexdigest()))
    assert planted > 20
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
