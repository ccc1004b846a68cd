import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from playlog.llm import lexical
from playlog.llm.queries import ORACLE, QUERIES
from tests.llm import helpers as H
from tools.compare import digest, duck

ITEMS = [(1, "the quick fox"), (2, "word1x7919 word2x15838 THE the the"), (3, None), (4, ""), (5, "?!"),
         (None, "lazy dog"), (6, "été 日本 x"), (7, "absent terms only"), (1, "the quick fox"), (1, "another text"),
         (8, "The, quick; FOX")]


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", H.ascii_lower(text or ""))


def _plain(rows, items, k=10):
    """(item, rank, id, score), every document scored for every item."""
    docs = [(i, Counter(t), len(t)) for i, t in ((i, _terms(t)) for i, t in rows) if t]
    total = sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, body in {(i, " ".join(_terms(t))) for i, t in items}:
        scored = []
        for i, c, n in docs:
            m = 100 - 75 + (75 * n * len(docs)) // total
            s = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in body.split() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def _items(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "*", "'c' AS item", "'c' AS body", "'c' AS class", "'c' AS n")


def _got(df):
    return sorted((tuple(r) for r in df.select("item", "rank", "id", "score").collect()), key=repr)


@pytest.mark.parametrize("block_terms", [1 << 20, 4])
def test_matches_plain_version(spark, block_terms):
    got = lexical.search(H.docs(spark, clash=True), _items(spark), block_terms=block_terms)
    want = _plain(H.odd_texts(), ITEMS)
    assert _got(got) == want and {r[0] for r in want} >= {1, 2, None, 6, 8}


def _random_rows(n, seed=5):
    r = random.Random(seed)
    vocabulary = [f"t{int(r.paretovariate(0.7))}" for _ in range(4000)]
    topics = [r.sample(vocabulary, 30) for _ in range(25)]
    return [(i // 2, " ".join(r.choices(r.choice(topics), k=r.randint(1, 60)) + r.choices(vocabulary, k=r.randint(0, 40))))
            for i in range(n)]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_random_texts(spark, k, monkeypatch):
    rows = _random_rows(1500)
    items = [(i, t) for i, t in _random_rows(60, 6)]
    got = lexical.search(H.docs(spark, rows).repartition(3), _items(spark, items), k=k)
    assert _got(got) == _plain(rows, items, k)


def test_copies_and_ties(spark):
    """A third of all rows alike; equal scores by the smaller id."""
    rows = [(i, "same words here") for i in range(900, 0, -1)] + [(1000 + i, f"other text {i}") for i in range(1800)]
    items = [(1, "same words"), (2, "other"), (3, "text 1799")]
    assert _got(lexical.search(H.docs(spark, rows), _items(spark, items))) == _plain(rows, items)


def test_bounds_prune_without_loss():
    """Node bounds hold for all below, and most pairs are never met."""
    r = np.random.default_rng(1)
    width, n = 300, 700
    sets = [np.sort(r.choice(np.arange(30) + 30 * (i // 70 % 10), 12, replace=False)) for i in range(n)]
    row, col = np.repeat(np.arange(n), 12), np.concatenate(sets)
    tree = lexical.Tree(row, col, r.integers(1, 1000, len(col)), width)
    v = r.integers(0, 50, width)
    low = tree.dots(0, np.arange(n), v)
    plain = np.zeros(n, np.int64)
    np.add.at(plain, row, tree.levels[0][2] * v[col])
    assert (low == plain).all()
    for level in range(1, tree.top + 1):
        bound = tree.dots(level, np.arange(tree.size(level)), v)
        for j in range(tree.size(level)):
            assert low[j * 8 ** level:(j + 1) * 8 ** level].max() <= bound[j]
        some = np.asarray([tree.size(level) - 1])
        assert tree.below(level, some).max() == tree.size(level - 1) - 1

    bags = [(sorted({int(c) for c in sets[i]}), [1] * 12) for i in range(0, n, 35)]
    items = lexical.Items(bags, np.full(width, 100, np.int64), np.zeros(len(bags), np.int64), 5)
    met = []
    offer = items.offer
    items.offer = lambda nodes, s, key: (met.append(len(nodes)), offer(nodes, s, key))
    for _ in range(4):
        items.search(list(range(n)), row, col, np.full(len(col), 7, np.int64), col[::12] * 0 + row[::12])
    assert sum(met) < len(bags) * n  # of four times as many pairs


def test_empty_tables(spark):
    assert lexical.search(H.empty(spark), _items(spark)).count() == 0
    assert lexical.search(H.docs(spark), _items(spark, [(1, None), (2, "?")])).count() == 0
    assert lexical.search(H.docs(spark, [(1, None), (2, "..")]), _items(spark)).count() == 0


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op13_lexical"](spark, sf_small)
    cur = duck(sf_small).execute(ORACLE["op13_lexical"])
    want = cur.fetchall()
    assert len(want) == 400
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(want, [d[0] for d in cur.description])
