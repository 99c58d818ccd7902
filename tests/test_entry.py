"""The driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tideline.plans.oracle import ORACLE_SQL
from tideline.plans.queries import QUERIES
from tideline.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "signal", "value", "ts"]
    rows = df.collect()
    assert len(rows) > 0 and {r.signal for r in rows} <= {"BUY", "SELL"}


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck001():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(rows, cols):
    import collections
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in idx) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck001, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = duck001.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(rows, df.columns) == _bag(cur.fetchall(), ocols)


_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
          "boolean": "BOOLEAN", "int": "INTEGER"}


def test_column_types_match_oracle(spark, duck001):
    bad = {}
    for name, q in QUERIES.items():
        spark_types = dict(q(spark, SF001).dtypes)
        duck_types = {d[0]: d[1] for d in duck001.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()}
        diff = {c: (t, duck_types.get(c)) for c, t in spark_types.items() if _TYPES.get(t, t) != duck_types.get(c)}
        if diff:
            bad[name] = diff
    assert bad == {}
