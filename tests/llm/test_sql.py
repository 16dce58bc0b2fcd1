"""Queries against their SQL on a small table set, rows and column types."""

from __future__ import annotations

import duckdb
import pytest

from adevents.llm import oracles, queries

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_sharding", "op9_substring_dedup", "op10_ngram_jaccard_join"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = queries.QUERIES[name](spark, SF)
    wanted = con.sql(oracles.ORACLES[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in found.schema} == {
        c: str(t) for c, t in zip(wanted.columns, wanted.types)
    }
    rows = {c: i for i, c in enumerate(wanted.columns)}
    expected = [tuple(r[rows[c]] for c in found.columns) for r in wanted.fetchall()]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
