from __future__ import annotations

import datetime as dt

import pytest

from adevents.functions.predicates import apply_filters


def n(df, *conds):
    return apply_filters(df, list(conds)).count()


def test_each_operator(events):
    total = events.count()
    jp = n(events, {"col": "country", "op": "eq", "val": "JP"})
    assert 0 < jp < total
    # neq drops NULL countries as SQL does
    us = n(events, {"col": "country", "op": "eq", "val": "US"})
    nulls = events.where("country IS NULL").count()
    assert n(events, {"col": "country", "op": "neq", "val": "US"}) == total - us - nulls
    lt = n(events, {"col": "advertiser_id", "op": "lt", "val": 5})
    gte = n(events, {"col": "advertiser_id", "op": "gte", "val": 5})
    assert lt + gte == total
    lte = n(events, {"col": "advertiser_id", "op": "lte", "val": 5})
    gt = n(events, {"col": "advertiser_id", "op": "gt", "val": 5})
    assert lte + gt == total
    both = n(events, {"col": "country", "op": "in", "val": ["US", "JP"]})
    assert both == us + jp


def test_values_are_cast_to_column_type(events):
    as_text = n(events, {"col": "advertiser_id", "op": "eq", "val": "7"})
    as_int = n(events, {"col": "advertiser_id", "op": "eq", "val": 7})
    assert as_text == as_int > 0
    # a date column compared with a date text (a type error in plain SQL text)
    day_text = n(events, {"col": "day", "op": "gte", "val": "2024-01-03"})
    day_date = n(events, {"col": "day", "op": "gte", "val": dt.date(2024, 1, 3)})
    assert day_text == day_date > 0


def test_between_is_inclusive(events):
    days = n(events, {"col": "day", "op": "between", "val": ["2024-01-02", "2024-01-02"]})
    assert days == n(events, {"col": "day", "op": "eq", "val": "2024-01-02"})


def test_conjunction_and_empty(events):
    assert n(events) == events.count()
    a = {"col": "type", "op": "eq", "val": "impression"}
    b = {"col": "country", "op": "eq", "val": "DE"}
    assert n(events, a, b) == events.where("type = 'impression' AND country = 'DE'").count()


def test_in_empty_list_matches_nothing(events):
    assert n(events, {"col": "country", "op": "in", "val": []}) == 0


def test_unknown_operator_raises(events):
    with pytest.raises(ValueError, match="unknown operator"):
        apply_filters(events, [{"col": "country", "op": "like", "val": "J%"}])


def test_unknown_column_raises(events):
    with pytest.raises(ValueError, match="unknown column"):
        apply_filters(events, [{"col": "nope", "op": "eq", "val": 1}])


def test_between_needs_two_values(events):
    with pytest.raises(ValueError):
        apply_filters(events, [{"col": "day", "op": "between", "val": "2024-01-01"}])


IDS = [2, 7, 12, 13, -1, -2, None]


@pytest.mark.parametrize(
    "op,val,want",
    [
        ("lt", 12.5, [-2, -1, 2, 7, 12]), ("gte", 12.5, [13]), ("eq", 12.7, []), ("neq", 12.7, [-2, -1, 2, 7, 12, 13]),
        ("lte", -1.5, [-2]), ("gt", -1.5, [-1, 2, 7, 12, 13]), ("between", [2.5, "12.5"], [7, 12]), ("in", [2, 12.5, "7", None, 10**12], [2, 7]),
        ("lt", 3_000_000_000, [-2, -1, 2, 7, 12, 13]), ("gt", 3_000_000_000, []), ("gt", float("-inf"), [-2, -1, 2, 7, 12, 13]),
        ("lt", float("nan"), [-2, -1, 2, 7, 12, 13]), ("eq", float("nan"), []), ("eq", None, []), ("lte", -3_000_000_000, []), ("in", [], []),
    ],
)
def test_values_are_not_cut_to_an_integer_column(spark, op, val, want):
    df = spark.createDataFrame([(i,) for i in IDS], "x int")
    assert sorted(r.x for r in apply_filters(df, [{"col": "x", "op": op, "val": val}]).collect()) == want


def test_fractional_bounds_are_pushed_down(spark, scratch):
    spark.createDataFrame([(i,) for i in IDS], "x int").write.parquet(scratch)
    plan = apply_filters(spark.read.parquet(scratch), [{"col": "x", "op": "lt", "val": 12.5}])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(x,12)" in plan


def test_a_date_column_takes_whole_days_only(spark):
    df = spark.sql("SELECT DATE '2024-06-01' AS day")
    for val in ("2024-06-01 12:00:00", "soon", 7):
        with pytest.raises(ValueError):
            apply_filters(df, [{"col": "day", "op": "lt", "val": val}])
    assert apply_filters(df, [{"col": "day", "op": "eq", "val": "2024-06-01 00:00:00"}]).count() == 1
    with pytest.raises(ValueError, match="not a number"):
        apply_filters(spark.range(1), [{"col": "id", "op": "eq", "val": "abc"}])
