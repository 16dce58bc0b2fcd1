"""The space-filling order of the store: bounds, bits, and row groups that a filter skips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adevents.sources.layout import Curve, bucket_bounds, bucket_of, interleave
from adevents.sources.store import read_store, write_store
from tests.conftest import SF_MID, SF_SMALL

FILTERS = {
    "country": "country = 'JP'",
    "publisher_id": "publisher_id BETWEEN 20 AND 29",
    "minute": "substring(minute, 12, 5) BETWEEN '06:00' AND '09:59' AND minute BETWEEN '2024-01-15 06:00' AND '2024-01-15 09:59'",
}


def _rows_read(df) -> int:
    """Rows in the row groups that the scan opened (the scan's own metric)."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_bounds_are_the_share_of_smaller_rows(spark):
    values = [None] * 5 + [1] * 40 + [2] + [3] * 3 + list(range(10, 66))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    bounds = bucket_bounds(df, F.col("v"), 4)
    kept = sorted(v for v in values if v is not None)
    want = {v: sum(k < v for k in kept) * 16 // len(kept) for v in kept}
    smallest = {}
    for v in kept:
        smallest.setdefault(want[v], v)
    assert bounds == sorted(smallest.items())
    got = df.distinct().select("v", bucket_of(F.col("v"), bounds).alias("b")).collect()
    assert {r.v: r.b for r in got} == {**want, None: 0}
    outside = spark.createDataFrame([(-9,), (7,), (900,)], "v long").select(bucket_of(F.col("v"), bounds).alias("b")).collect()
    assert [r.b for r in outside] == [0, want[3], want[65]]


def test_empty_and_all_null_columns_have_one_bucket(spark):
    df = spark.createDataFrame([(None,), (None,)], "v string")
    assert bucket_bounds(df, F.col("v"), 4) == [] == bucket_bounds(df.limit(0), F.col("v"), 4)
    assert [r.b for r in df.select(bucket_of(F.col("v"), []).alias("b")).collect()] == [0, 0]


def test_bits_are_taken_in_turn(spark):
    rows = [(a, b, c) for a in (0, 1, 5, 7) for b in (0, 2, 6) for c in (0, 3, 4)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = df.withColumn("z", interleave([F.col(x) for x in "abc"], 3)).collect()
    for r in got:
        bits = "".join(f"{(x >> i) & 1}" for i in (2, 1, 0) for x in (r.a, r.b, r.c))
        assert r.z == int(bits, 2)
    with pytest.raises(ValueError):
        interleave([F.col("a")] * 8, 8)


def test_rows_are_kept_and_empty_stores_write(spark, events, scratch):
    write_store(events.unionByName(events.limit(0)), scratch + "/a", curve=Curve())
    back = read_store(spark, scratch + "/a")
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0
    write_store(events.limit(0), scratch + "/b", curve=Curve())
    twice = events.unionByName(events)
    write_store(twice, scratch + "/c", curve=Curve(bits=3))
    assert read_store(spark, scratch + "/c").exceptAll(twice).count() == 0


def test_filters_on_each_dimension_skip_row_groups(spark, scratch):
    """Along the curve each dimension's filter reads about half of the rows or less; the sort can't skip for its last column."""
    from adevents.plans.adapter import load_ad_events

    # one directory, so that only row groups can be skipped
    events = load_ad_events(spark, SF_MID).withColumns({"type": F.lit("impression"), "day": F.lit("2024-01-15").cast("date")})
    at = F.concat(F.lit("2024-01-15 "), F.substring("minute", 12, 5))
    events = events.withColumn("minute", at)
    n = events.count()
    write_store(events, scratch + "/curve", curve=Curve(row_group_rows=100))
    rows = (
        events.repartition(1)
        .sortWithinPartitions("country", "publisher_id", "minute")
        .write.option("parquet.block.row.count.limit", "100")
    )
    rows.partitionBy("type", "day").parquet(scratch + "/sorted")
    read = {}
    for kind in ("curve", "sorted"):
        store = read_store(spark, f"{scratch}/{kind}")
        read[kind] = {d: _rows_read(store.where(c).select("auction_id")) for d, c in FILTERS.items()}
        for d, c in FILTERS.items():
            assert store.where(c).count() == events.where(c).count()
    # 100 row groups: the sort reads everything for its last column and least for its first ones
    assert all(r < 0.55 * n for r in read["curve"].values()), (n, read)
    assert max(read["sorted"].values()) > 0.9 * n, (n, read)
    assert sum(read["curve"].values()) < sum(read["sorted"].values()), (n, read)


def test_registered_query_prunes_and_pushes_down(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["clustered_scan"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country,JP)" in plan and "GreaterThanOrEqual(publisher_id,20)" in plan
    assert "PartitionFilters: []" in plan and "Exchange" not in plan
