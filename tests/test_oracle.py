"""Every registered query against its DuckDB oracle (the driver's check)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from adevents.plans import catalog
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# Spark type -> DuckDB type name the oracle must produce for the same column.
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


# Operators that must not appear in a plan: pairs of rows, per-row Python, and the
# built-in percentile that gathers a whole group in one task.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Percentile")


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    duck_types = dict(zip(cols, (str(t) for t in con.sql(entry.oracle_sql()[key]).types)))
    for f in df.schema.fields:
        assert TYPE_NAMES.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType, duck_types[f.name])
    want = [tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert _norm(got) == _norm(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "sum_bid_price"]
    assert df.count() > 0
