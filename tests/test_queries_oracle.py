"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive value digest)."""

import pytest

import __spark_entry__ as E
from playlog.plans.catalog import QUERIES
from tools.compare import digest, duck, types_match

NAMES = sorted(QUERIES)


def test_every_query_has_oracle():
    """Every query of the library; the optional training-data operators have tests of their own."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert types_match(df, cur) == []
    assert len(got) == len(want)
    assert digest(got, df.columns) == digest(want, want_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["rank", "player", "season", "points"]
    assert 0 < df.count() <= 11
