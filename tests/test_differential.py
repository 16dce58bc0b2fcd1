"""Differential check: random report specs, Spark against DuckDB.

Each generated spec runs through ``report()`` on the prepared store and,
as SQL built here from the same clauses, through DuckDB on the driver's
events table (mapped by the oracle adapter).  Results must agree as sets
after rounding.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from adevents.operators.report import report
from adevents.plans.prepare import prepared_for
from tests.conftest import SF_SMALL

KEYS = ["day", "type", "country", "advertiser_id", "hour"]
MEASURES = ["bid_price", "total_price", "advertiser_id"]
FUNCS = ["SUM", "AVG", "MIN", "MAX", "COUNT"]

CONDITIONS = [
    {"col": "type", "op": "eq", "val": "impression"},
    {"col": "type", "op": "neq", "val": "error"},
    {"col": "country", "op": "in", "val": ["US", "DE", "IN"]},
    {"col": "country", "op": "neq", "val": "JP"},
    {"col": "day", "op": "between", "val": ["2024-01-04", "2024-01-19"]},
    {"col": "day", "op": "gte", "val": "2024-01-10"},
    {"col": "advertiser_id", "op": "lt", "val": 9},
    {"col": "advertiser_id", "op": "gt", "val": "3"},
    {"col": "bid_price", "op": "lte", "val": 60},
    {"col": "publisher_id", "op": "between", "val": [10, 70]},
    {"col": "minute", "op": "lt", "val": "2024-01-20 00:00"},
]

SQL_OPS = {"eq": "=", "neq": "<>", "lt": "<", "lte": "<=", "gt": ">", "gte": ">="}
TYPES = {"day": "DATE", "advertiser_id": "INTEGER", "publisher_id": "INTEGER", "bid_price": "DOUBLE"}


def _lit(col, v):
    t = TYPES.get(col, "VARCHAR")
    return f"CAST('{v}' AS {t})"


def to_sql(select_keys, aggs, where):
    conds = []
    for c in where:
        col, op, val = c["col"], c["op"], c["val"]
        if op == "between":
            conds.append(f"{col} BETWEEN {_lit(col, val[0])} AND {_lit(col, val[1])}")
        elif op == "in":
            conds.append(f"{col} IN ({', '.join(_lit(col, v) for v in val)})")
        else:
            conds.append(f"{col} {SQL_OPS[op]} {_lit(col, val)}")
    items = list(select_keys)
    for f, col in aggs:
        name = "count_star" if col == "*" else f"{f.lower()}_{col}"
        items.append(f"{f}({col}) AS {name}")
    sql = f"SELECT {', '.join(items)} FROM ad_events"
    if conds:
        sql += " WHERE " + " AND ".join(conds)
    if select_keys:
        sql += " GROUP BY " + ", ".join(select_keys)
    return entry.AD_EVENTS + "\n" + sql


def _norm(rows):
    out = []
    for r in rows:
        vals = []
        for v in r:
            if isinstance(v, float):
                vals.append(None if math.isnan(v) else round(v, 4))
            elif isinstance(v, dt.datetime):
                vals.append(v.replace(tzinfo=None))
            else:
                vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.sampled_from(KEYS), unique=True, max_size=2),
    aggs=st.lists(st.tuples(st.sampled_from(FUNCS), st.sampled_from(MEASURES)), unique=True, min_size=1, max_size=3),
    count_star=st.booleans(),
    where=st.lists(st.sampled_from(CONDITIONS), unique_by=lambda c: (c["col"], c["op"]), max_size=3),
)
def test_random_reports_match_duckdb(spark, con, keys, aggs, count_star, where):
    store = prepared_for(spark, SF_SMALL).events(spark)
    all_aggs = list(aggs) + ([("COUNT", "*")] if count_star else [])
    select = list(keys) + [{f: c} for f, c in all_aggs]
    got = report(store, select=select, where=where, group_by=keys)
    res = con.execute(to_sql(keys, all_aggs, where))
    cols = [d[0] for d in res.description]
    assert got.columns == cols
    assert _norm(got.collect()) == _norm(res.fetchall())
