"""Typing rules on the FIXTURES rows (raw text -> typed events)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adevents.functions.typing import type_events
from adevents.schema import EVENTS_SCHEMA, RAW_COLUMNS, RAW_SCHEMA

ROWS = {
    "impression": ("1717200000123", "impression", "a1", "7", "12", "0.0431", "99", None, "JP"),
    "purchase": ("1717200060000", "purchase", "a2", "7", "12", None, "99", "51.25", "US"),
    "bad_ts": ("oops", "impression", "a3", "7", "12", "0.1", "99", None, "US"),
    "bad_ids": ("1717200000000", "impression", "a4", "x", "12.7", "0.1", "1e3", None, "US"),
    "na_country": ("1717200000000", "impression", "a6", "7", "12", "0.1", "99", None, "NA"),
    "empty_country": ("1717200000000", "impression", "a7", "7", "12", "0.1", "99", None, None),
    "empty_price_text": ("1717200000000", "impression", "a8", "7", "12", "", "99", "", "US"),
}


def typed(spark, *names, bad_price="error"):
    raw = spark.createDataFrame([ROWS[n] for n in names], RAW_SCHEMA)
    return {r.auction_id: r for r in type_events(raw, bad_price=bad_price).collect()}


def test_schema_is_fixed(spark):
    raw = spark.createDataFrame([ROWS["impression"]], RAW_SCHEMA)
    assert type_events(raw).schema == EVENTS_SCHEMA


def test_plain_impression(spark):
    r = typed(spark, "impression")["a1"]
    assert r.ts == dt.datetime(2024, 6, 1, 0, 0, 0, 123000)
    assert r.week == dt.datetime(2024, 5, 27)  # Monday
    assert r.day == dt.date(2024, 6, 1)
    assert r.hour == dt.datetime(2024, 6, 1, 0)
    assert r.minute == "2024-06-01 00:00"
    assert (r.advertiser_id, r.publisher_id, r.user_id) == (7, 12, 99)
    assert r.bid_price == pytest.approx(0.0431) and r.total_price is None


def test_purchase(spark):
    r = typed(spark, "purchase")["a2"]
    assert r.bid_price is None and r.total_price == 51.25
    assert r.minute == "2024-06-01 00:01"


def test_bad_ts_keeps_row(spark):
    r = typed(spark, "bad_ts")["a3"]
    assert (r.ts, r.week, r.day, r.hour, r.minute) == (None,) * 5
    assert r.type == "impression"


def test_bad_ids_are_null(spark):
    r = typed(spark, "bad_ids")["a4"]
    assert (r.advertiser_id, r.publisher_id, r.user_id) == (None, None, None)


def test_country_na_kept_and_empty_is_null(spark):
    got = typed(spark, "na_country", "empty_country")
    assert got["a6"].country == "NA"
    assert got["a7"].country is None


def test_empty_price_text_is_null(spark):
    r = typed(spark, "empty_price_text")["a8"]
    assert r.bid_price is None and r.total_price is None


def test_bad_price_raises(spark):
    raw = spark.createDataFrame([("1717200000000", "impression", "a5", "7", "12", "abc", "99", None, "US")], RAW_SCHEMA)
    with pytest.raises(PySparkException, match="malformed bid_price"):
        type_events(raw).collect()


def test_bad_price_null_mode(spark):
    raw = spark.createDataFrame([("1717200000000", "impression", "a5", "7", "12", "abc", "99", None, "US")], RAW_SCHEMA)
    assert type_events(raw, bad_price="null").collect()[0].bid_price is None


def test_time_zone_is_utc_for_buckets(spark):
    # 23:30 UTC stays on the same UTC day whatever the machine zone is
    raw = spark.createDataFrame([("1717284600000", "impression", "z", "1", "1", "1", "1", None, "US")], RAW_SCHEMA)
    r = type_events(raw).collect()[0]
    assert r.day == dt.date(2024, 6, 1) and r.minute == "2024-06-01 23:30"


def test_fractional_millis(spark):
    raw = spark.createDataFrame([("1717200000123.5", "impression", "f", "1", "1", "1", "1", None, "US")], RAW_SCHEMA)
    assert type_events(raw).collect()[0].ts == dt.datetime(2024, 6, 1, 0, 0, 0, 123500)


def test_missing_raw_column_raises(spark):
    raw = spark.createDataFrame([("1",)], "ts string")
    with pytest.raises(ValueError):
        type_events(raw)


def test_raw_columns_match_schema():
    assert tuple(f.name for f in RAW_SCHEMA.fields) == RAW_COLUMNS
    assert all(str(f.dataType) == "StringType()" for f in RAW_SCHEMA.fields)


def test_projection_is_one_codegen_stage(spark):
    raw = spark.createDataFrame([ROWS["impression"]], RAW_SCHEMA)
    plan = type_events(raw).where(F.col("day").isNotNull())._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_out_of_range_epoch_is_null(spark):
    raw = spark.createDataFrame(
        [("1e20", "impression", "big", "1", "1", "1", "1", None, "US"), ("NaN", "impression", "nan", "1", "1", "1", "1", None, "US")],
        RAW_SCHEMA,
    )
    rows = {r.auction_id: r for r in type_events(raw).collect()}
    assert rows["big"].ts is None and rows["nan"].ts is None


@pytest.mark.parametrize("price", ["1d", "2f", "0x10", "1_000", "1 2", "--1", ".", "e5"])
def test_text_that_is_no_number_raises_as_a_price(spark, price):
    raw = spark.createDataFrame([("1717200000000", "impression", "a", "1", "1", price, "1", None, "US")], RAW_SCHEMA)
    with pytest.raises(PySparkException, match="malformed bid_price"):
        type_events(raw).collect()
    assert type_events(raw, bad_price="null").collect()[0].bid_price is None


def test_number_texts(spark):
    from adevents.functions.typing import soft_double

    texts = ["1", "-1.5", "+.5", "2.", "1e3", "1E-2", " 7 ", "1d", "3F", "", None, "NaN", "-inf"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(soft_double(F.col("t")).alias("x")).collect()
    got = [None if r.x is None else str(r.x) for r in rows]
    assert got == ["1.0", "-1.5", "0.5", "2.0", "1000.0", "0.01", "7.0", None, None, None, None, "nan", "-inf"]
    raw = spark.createDataFrame([("12d", "click", "a", "1", "1", None, "1", None, "US")], RAW_SCHEMA)
    assert type_events(raw).collect()[0].ts is None
