import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from playlog.session import build_session

    s = build_session("local[*]", app="playlog-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def no_broadcast(spark):
    """Context in which Spark plans every join as a shuffled one."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")

    @contextlib.contextmanager
    def off():
        for k in keys:
            spark.conf.set(k, "-1")
        try:
            yield
        finally:
            for k in keys:
                spark.conf.unset(k)

    return off


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("supplied tables not present")
    return SF_SMALL


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is None, v) for v in t))
