from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import build_session
    # Jobs resume under their names, so every run of the tests has a folder of its own.
    s = build_session("local[8]", app_name="tideline-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tideline-tests-"),
                                  "spark.driver.memory": "6g"})  # local mode: eight tasks share the driver's heap
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tideline.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF01, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def bag(rows, ndigits=None):
    """Order-insensitive multiset of row tuples (doubles optionally rounded)."""
    import collections

    def norm(v):
        if isinstance(v, float) and ndigits is not None:
            return round(v, ndigits)
        return v
    return collections.Counter(tuple(norm(v) for v in r) for r in rows)
