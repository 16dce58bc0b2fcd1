"""Property tests: typing rules and predicates against plain Python."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adevents.functions.predicates import apply_filters
from adevents.functions.typing import calendar_columns, epoch_millis_to_ts, ts_to_epoch_millis

EPOCH = dt.datetime(1970, 1, 1)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=4_102_444_800_000), min_size=1, max_size=50))
def test_epoch_millis_roundtrip_and_buckets(spark, millis):
    df = spark.createDataFrame([(str(m),) for m in millis], "t string")
    ts = epoch_millis_to_ts(F.col("t"))
    cal = calendar_columns(ts)
    rows = df.select(
        F.col("t"), ts.alias("ts"), ts_to_epoch_millis(ts).alias("back"), *[c.alias(n) for n, c in cal.items()]
    ).collect()
    for r in rows:
        want = EPOCH + dt.timedelta(milliseconds=int(r.t))
        assert r.ts == want and r.back == int(r.t)
        assert r.day == want.date()
        assert r.hour == want.replace(minute=0, second=0, microsecond=0)
        assert r.minute == want.strftime("%Y-%m-%d %H:%M")
        monday = want.date() - dt.timedelta(days=want.weekday())
        assert r.week == dt.datetime.combine(monday, dt.time())


VALUES = st.one_of(st.none(), st.integers(min_value=-5, max_value=5))


@SETTINGS
@given(
    st.lists(VALUES, min_size=1, max_size=40),
    st.sampled_from(["eq", "neq", "lt", "lte", "gt", "gte", "between", "in"]),
    st.integers(min_value=-5, max_value=5),
    st.integers(min_value=0, max_value=4),
)
def test_predicates_match_python(spark, values, op, v, width):
    df = spark.createDataFrame([(x,) for x in values], "x int")
    if op == "between":
        val = [v, v + width]
    elif op == "in":
        val = list(range(v, v + width))
    else:
        val = str(v)  # text values are cast to the column's type
    got = sorted(r.x for r in apply_filters(df, [{"col": "x", "op": op, "val": val}]).collect())
    s = pd.Series(values, dtype="Int64").dropna()  # comparisons with NULL never hold
    pick = {
        "eq": s == v, "neq": s != v, "lt": s < v, "lte": s <= v, "gt": s > v, "gte": s >= v,
        "between": (s >= v) & (s <= v + width), "in": s.isin(list(range(v, v + width))),
    }[op]
    assert got == sorted(int(x) for x in s[pick])
