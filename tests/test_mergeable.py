"""Mergeable measures, answers over parts of days, keyed comparison, quarantine."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from adevents.operators.compare import compare_keyed
from adevents.operators.hybrid import check_hybrid, hybrid_report, split_range
from adevents.operators.report import report
from adevents.operators.rollups import (
    BID_VALUES,
    BIDS,
    DAILY_REVENUE,
    USERS,
    NotCovered,
    Rollup,
    bucket_bounds,
    build_rollup,
    covers,
    rollup_quantile,
    rollup_report,
    value_bucket,
)

SPREADS = {"STDDEV": "bid_price", "VARIANCE": "bid_price", "STDDEV_POP": "bid_price", "VAR_POP": "total_price"}


def _rows(df, digits=6):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keys", [[], ["country"], ["day", "country", "advertiser_id"], ["day"]])
def test_spreads_equal_the_events(events, keys):
    clauses = dict(select=[*keys, SPREADS], group_by=keys)
    got, want = _rows(rollup_report(BIDS, build_rollup(events, BIDS), **clauses), 3), _rows(report(events, **clauses), 3)
    assert len(got) == len(want) > 0
    for g, w in zip(got, want):
        assert g[: len(keys)] == w[: len(keys)] and g[len(keys) :] == tuple(x if x is None else pytest.approx(x, abs=2e-3, rel=1e-6) for x in w[len(keys) :])


def test_spreads_of_values_far_from_zero(spark):
    rng = random.Random(1)
    rows = [(dt.date(2024, 1, 1 + i % 9), "US" if i % 2 else None, i % 3, 1e9 + rng.random(), None) for i in range(2000)]
    rows += [(dt.date(2024, 1, 1), "DE", 1, 5.0, None), (dt.date(2024, 1, 2), "FR", 1, None, None)]
    events = spark.createDataFrame(rows, "day date, country string, advertiser_id int, bid_price double, total_price double")
    got = rollup_report(BIDS, build_rollup(events, BIDS), select=["country", {"VARIANCE": "bid_price", "STDDEV_POP": "bid_price"}], group_by=["country"])
    got = {r.country: r for r in got.collect()}
    for country in ("US", None):
        values = [r[3] - 1e9 for r in rows if r[1] == country]
        assert got[country].variance_bid_price == pytest.approx(statistics.variance(values), rel=1e-6)
        assert got[country].stddev_pop_bid_price == pytest.approx(statistics.pstdev(values), rel=1e-6)
    assert got["DE"].variance_bid_price is None and got["DE"].stddev_pop_bid_price == 0
    assert got["FR"].variance_bid_price is None and got["FR"].stddev_pop_bid_price is None


@pytest.mark.parametrize("keys", [[], ["country"], ["day", "type", "country"]])
def test_distinct_counts_equal_the_events(events, keys):
    wide = events.withColumn("user_id", F.when(F.col("user_id") % 7 == 0, None).otherwise((F.col("user_id") - 300) * 100_003))
    clauses = dict(select=[*keys, "COUNT(DISTINCT user_id)"], group_by=keys, where=[{"col": "day", "op": "gte", "val": "2024-01-09"}])
    assert _rows(rollup_report(USERS, build_rollup(wide, USERS), **clauses)) == _rows(report(wide, **clauses))


def test_distinct_counts_of_groups_with_nulls_only(spark):
    rows = [(dt.date(2024, 1, 1), "click", "US", None), (dt.date(2024, 1, 1), "click", "DE", 2**40), (dt.date(2024, 1, 2), "click", "DE", 2**40)]
    table = build_rollup(spark.createDataFrame(rows, "day date, type string, country string, user_id long"), USERS)
    got = rollup_report(USERS, table, select=["country", "COUNT(DISTINCT user_id)"], group_by=["country"])
    assert _rows(got) == [("DE", 1), ("US", 0)]
    none = rollup_report(USERS, table, select=["COUNT(DISTINCT user_id)"], where=[{"col": "type", "op": "eq", "val": "x"}])
    assert _rows(none) == [(0,)]


def test_what_mergeable_tables_cover():
    assert not covers(USERS, select=["country", "COUNT(*)"], group_by=["country"])
    assert not covers(BIDS, select=["SUM(bid_price)"]) and not covers(DAILY_REVENUE, select=["STDDEV(bid_price)"])
    with pytest.raises(ValueError):
        Rollup("x", ("day",), (("a", "distinct", "user_id"), ("n", "count", "*")))
    with pytest.raises(NotCovered):
        rollup_quantile(DAILY_REVENUE, None, 0.5)


def test_buckets_hold_their_values(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 1.0, 2.0, 8.0, 0.1, 1e-300, 1.7e308, 1 - 2**-53, 2**-0.5, 3.0, -3.0, -1e9]
    values += [rng.choice([-1, 1]) * 10 ** rng.uniform(-20, 20) for _ in range(500)] + [2.0**k for k in range(-60, 60)]
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn("b", value_bucket(F.col("x")))
    low, high = bucket_bounds(F.col("b"))
    got = df.select("x", "b", low.alias("low"), high.alias("high")).collect()
    for r in got:
        assert (r.low <= r.x < r.high) if r.x > 0 else (r.low < r.x <= r.high) if r.x < 0 else r.low == r.high == 0
        assert r.x == 0 or math.isinf(r.high) or abs(r.high - r.low) <= min(abs(r.low), abs(r.high)) / 16 * (1 + 1e-9) or abs(r.x) < 1e-300
    ordered = sorted(got, key=lambda r: r.x)
    assert [r.b for r in ordered] == sorted(r.b for r in got)
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(value_bucket(F.col("x"))).collect()
    assert [r[0] for r in none] == [None, None]


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile_bounds_hold_the_exact_value(events, q):
    where = [{"col": "type", "op": "eq", "val": "impression"}]
    table = build_rollup(events, BID_VALUES)
    values: dict = {}
    for r in events.where("type = 'impression' AND bid_price IS NOT NULL").select("country", "bid_price").collect():
        values.setdefault(r.country, []).append(r.bid_price)
    got = {r.country: r for r in rollup_quantile(BID_VALUES, table, q, ["country"], where).collect()}
    assert set(got) == set(values)
    for country, xs in values.items():
        r, xs = got[country], sorted(xs)
        assert r.n == len(xs) and r.rank == max(1, math.ceil(q * len(xs))) and r.first_rank <= r.rank <= r.last_rank
        assert r.low <= xs[r.rank - 1] <= r.high
        assert r.first_rank == sum(x < r.low for x in xs) + 1 and r.last_rank == sum(x < r.high for x in xs)
    everything = rollup_quantile(BID_VALUES, table, q, (), where).collect()
    assert len(everything) == 1 and everything[0].n == sum(map(len, values.values()))


# ---- parts of days ---------------------------------------------------------------

IMPRESSION = {"col": "type", "op": "eq", "val": "impression"}
RANGES = [
    [{"col": "hour", "op": "between", "val": ["2024-01-05 06:00:00", "2024-01-20 17:00:00"]}],
    [{"col": "hour", "op": "gte", "val": "2024-01-05"}, {"col": "hour", "op": "lt", "val": "2024-01-09"}],
    [{"col": "ts", "op": "gt", "val": "2024-01-05 00:00:00"}, {"col": "ts", "op": "lte", "val": "2024-01-08 23:59:59.999999"}],
    [{"col": "minute", "op": "between", "val": ["2024-01-05 13:15", "2024-01-09 23:59"]}],
    [{"col": "hour", "op": "gte", "val": dt.datetime(2024, 1, 7, 3)}],
    [{"col": "ts", "op": "lt", "val": "2024-01-07 03:30:00"}],
    [{"col": "hour", "op": "gte", "val": "2024-01-05 06:00"}, {"col": "ts", "op": "gte", "val": "2024-01-07 12:30"}, {"col": "ts", "op": "lt", "val": "2024-01-12 01:00"}],
]


@pytest.mark.parametrize("time", RANGES)
def test_hybrid_reports_equal_the_events(events, time):
    clauses = dict(
        select=["country", "SUM(bid_price)"], where=[IMPRESSION, *time, {"col": "country", "op": "neq", "val": "BR"}], group_by=["country"],
        order_by=[{"col": "SUM(bid_price)", "dir": "desc"}],
    )
    got = hybrid_report(DAILY_REVENUE, build_rollup(events, DAILY_REVENUE), events, **clauses)
    assert _rows(got, 4) == _rows(report(events, **clauses), 4)


def test_split_ranges():
    d = lambda n: dt.date(2024, 1, n)
    found = [split_range(r, ("day",)) for r in RANGES]
    assert [(s.first, s.last, s.cut) for s in found[:4]] == [
        (d(6), d(19), (d(5), d(20))), (d(5), d(8), ()), (d(6), d(8), (d(5),)), (d(6), d(9), (d(5),))
    ]
    assert found[4].last is None and found[5].cut == (d(7),)
    for where in ([IMPRESSION], [{"col": "hour", "op": "eq", "val": "2024-01-05 01:00:00"}], [{"col": "ts", "op": "lt", "val": "soon"}]):
        with pytest.raises(NotCovered):
            split_range(where, ("day",))
    one_day = [{"col": "hour", "op": "between", "val": ["2024-01-05 01:00", "2024-01-05 05:00"]}]
    with pytest.raises(NotCovered):
        check_hybrid(DAILY_REVENUE, select=["SUM(bid_price)"], where=[IMPRESSION, *one_day])


def test_hybrid_plans_read_the_cut_days_only(spark, events, scratch):
    from adevents.plans.answer import answer
    from adevents.plans.prepare import prepare

    store = prepare(events, scratch, rollups=(DAILY_REVENUE,))
    result, source = answer(spark, store, rollups=(DAILY_REVENUE,), select=["country", "SUM(bid_price)"], where=[IMPRESSION, *RANGES[0]], group_by=["country"])
    assert source == "daily_revenue+events"
    plan = result._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "total_revenue" not in line]
    assert scans and all(s.split("FileScan")[1] == scans[0].split("FileScan")[1] for s in scans)
    filters = scans[0].split("PartitionFilters: [")[1].split("], ")[0]
    assert "2024-01-05" in filters and "2024-01-20" in filters and "type" in filters
    _, other = answer(spark, store, rollups=(DAILY_REVENUE,), select=["SUM(bid_price)"], where=[IMPRESSION, {"col": "hour", "op": "in", "val": ["2024-01-05 06:00:00"]}])
    assert other == "events"


# ---- keyed comparison -------------------------------------------------------------


def test_keyed_comparison(spark):
    schema = "k int, l string, x double, n long, t string"
    a = spark.createDataFrame(
        [(1, "a", 1.0, 10, "s"), (2, None, 5.0, 1, "s"), (3, "c", float("nan"), 1, None), (4, "d", 100.0, 1, "s"), (5, "e", None, 1, "s"), (6, "f", 0.0, 2, "s")],
        schema,
    )
    b = spark.createDataFrame(
        [(1, "a", 1.05, 10, "s"), (2, None, 5.0, 1, "S"), (3, "c", float("nan"), 1, None), (4, "d", 109.0, 3, "s"), (5, "e", 0.0, 1, "s"), (7, "f", 0.0, 2, "s")],
        schema,
    ).select("t", "x", "n", "l", "k")
    got = {r.k: r for r in compare_keyed(a, b, ["k", "l"], absolute=0.06, relative=0.1).collect()}
    assert {k: (r.status, r.n_changed) for k, r in got.items()} == {2: ("changed", 1), 4: ("changed", 1), 5: ("changed", 1), 6: ("missing", 0), 7: ("added", 0)}
    assert got[4].n_diff == 2 and got[4].n_rel == pytest.approx(2 / 3) and got[4].x_diff == 9 and got[2].t_a == "s" and got[2].t_b == "S"
    assert compare_keyed(a, a, ["k"]).count() == 0
    assert {r.k for r in compare_keyed(a, b, ["k", "l"]).collect()} == {1, 2, 4, 5, 6, 7}
    with pytest.raises(Exception, match="a key occurs twice"):
        compare_keyed(a.unionByName(a), b, ["k", "l"]).collect()
    with pytest.raises(ValueError):
        compare_keyed(a, b.drop("t"), ["k"])


# ---- quarantine --------------------------------------------------------------------


def test_every_line_is_good_or_set_aside(spark, scratch):
    import os

    from adevents.schema import RAW_COLUMNS
    from adevents.sources.quarantine import read_with_quarantine, store_with_quarantine
    from adevents.sources.store import read_store

    os.makedirs(scratch)
    head = ",".join(RAW_COLUMNS)
    good = ["1704067200000,impression,a1,1,2,0.5,3,,US", "oops,impression,a2,x,2,,3,1e3,", '1704067200000,click,"a,3",1,2,,3,,JP']
    bad = ["1704067200000,impression,b1,1,2,zero,3,,US", "1704067200000,impression,b2,1,2,0.5,3", "1,click,b3,1,2,1d,3,x,US,more", "junk"]
    with open(f"{scratch}/events_part_0.csv", "w") as f:
        f.write("\n".join([head, good[0], bad[0], bad[1], good[1]]) + "\n")
    with open(f"{scratch}/events_part_1.csv", "w") as f:  # another order of columns
        f.write("country,ts,bid_price,auction_id\nUS,1704067200000,0.25,c1\nUS,1704067200000,--,c2\nUS\n")
    with open(f"{scratch}/events_part_2.csv", "w") as f:
        f.write("\n".join([head, good[2], bad[2], bad[3]]) + "\n")
    open(f"{scratch}/events_part_3.csv", "w").close()
    typed, aside = read_with_quarantine(spark, scratch)
    assert sorted(r.auction_id for r in typed.collect()) == ["a,3", "a1", "a2", "c1"]
    got = {r.line: (r.reason, r.file.rsplit("/", 1)[1]) for r in aside.collect()}
    assert got == {
        bad[0]: ("malformed bid_price", "events_part_0.csv"), bad[1]: ("wrong number of fields", "events_part_0.csv"),
        bad[2]: ("wrong number of fields", "events_part_2.csv"), bad[3]: ("wrong number of fields", "events_part_2.csv"),
        "US,1704067200000,--,c2": ("malformed bid_price", "events_part_1.csv"), "US": ("wrong number of fields", "events_part_1.csv"),
    }
    store_with_quarantine(spark, scratch, scratch + "/store", scratch + "/aside")
    assert read_store(spark, scratch + "/store").count() == 4 and spark.read.parquet(scratch + "/aside").count() == 6
    with pytest.raises(FileNotFoundError):
        read_with_quarantine(spark, scratch + "/aside")
