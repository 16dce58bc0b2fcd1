from __future__ import annotations

import pytest

from adevents.operators.compare import compare_results
from adevents.operators.report import report
from adevents.operators.rollups import COUNTS, PURCHASES, REVENUE, NotCovered, build_rollup, covers, rollup_report
from adevents.plans.reports import ROLLUP_OF, SPECS, on_events, on_rollup


@pytest.mark.parametrize("name", sorted(SPECS))
def test_rollup_answers_equal_event_answers(events, name):
    table = build_rollup(events, ROLLUP_OF[name])
    cmp = compare_results(on_events(name, events), on_rollup(name, table)).collect()[0]
    assert cmp.matched and cmp.same_header and cmp.rows_a == cmp.rows_b > 0


def test_revenue_rollup_grain(events):
    r = build_rollup(events, REVENUE)
    assert r.columns == ["minute", "day", "publisher_id", "country", "total_revenue"]
    assert r.count() == events.where("type = 'impression'").select("minute", "day", "publisher_id", "country").distinct().count()


def test_missing_fixed_filter_is_not_covered(events):
    with pytest.raises(NotCovered, match="only holds rows"):
        rollup_report(REVENUE, build_rollup(events, REVENUE), select=["day", "SUM(bid_price)"], group_by=["day"])


def test_filter_on_non_dimension_is_not_dropped(events):
    with pytest.raises(NotCovered, match="cannot filter"):
        rollup_report(
            REVENUE,
            build_rollup(events, REVENUE),
            select=["publisher_id", "SUM(bid_price)"],
            where=[{"col": "type", "op": "eq", "val": "impression"}, {"col": "advertiser_id", "op": "eq", "val": 3}],
            group_by=["publisher_id"],
        )


def test_underivable_aggregate(events):
    with pytest.raises(NotCovered):
        rollup_report(
            PURCHASES,
            build_rollup(events, PURCHASES),
            select=["country", "MEDIAN(total_price)"],
            where=[{"col": "type", "op": "eq", "val": "purchase"}],
            group_by=["country"],
        )


def test_covers_and_coarser_grouping(events):
    assert covers(COUNTS, select=["type", "COUNT(*)"], group_by=["type"])
    assert not covers(COUNTS, select=["country", "COUNT(*)"], group_by=["country"])
    got = rollup_report(COUNTS, build_rollup(events, COUNTS), select=["type", "COUNT(*)"], group_by=["type"])
    want = report(events, select=["type", "COUNT(*)"], group_by=["type"])
    assert compare_results(got, want).collect()[0].matched


def test_full_grain_needs_no_shuffle(events, scratch, spark):
    from adevents.operators.rollups import read_rollup, write_rollup

    path = write_rollup(build_rollup(events, COUNTS), COUNTS, scratch + "/counts")
    table = read_rollup(spark, COUNTS, path)
    r = rollup_report(COUNTS, table, select=["day", "advertiser_id", "type", "COUNT(*)"], group_by=["day", "advertiser_id", "type"])
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan


def test_revenue_rollup_prunes_days_and_pushes_country(events, scratch, spark):
    from adevents.operators.rollups import read_rollup, write_rollup
    from adevents.plans.reports import Q2

    path = write_rollup(build_rollup(events, REVENUE), REVENUE, scratch + "/revenue")
    r = rollup_report(REVENUE, read_rollup(spark, REVENUE, path), **Q2)
    plan = r._jdf.queryExecution().executedPlan().toString()
    part = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "day#" in part and "2024-01-20" in part
    assert "EqualTo(country,JP)" in plan


def test_rollup_report_keeps_select_order(events):
    table = build_rollup(events, REVENUE)
    r = rollup_report(REVENUE, table, select=[{"SUM": "bid_price"}, "day"], where=[{"col": "type", "op": "eq", "val": "impression"}], group_by=["day"])
    assert r.columns == ["sum_bid_price", "day"]


def test_average_of_all_null_prices_is_null(spark):
    from adevents.schema import EVENTS_SCHEMA

    rows = [(None,) * 5 + ("purchase", "a1", 1, 1, None, 1, None, "XX"), (None,) * 5 + ("purchase", "a2", 1, 1, None, 1, 5.0, "YY")]
    ev = spark.createDataFrame(rows, EVENTS_SCHEMA)
    got = {r.country: r.avg_total_price for r in rollup_report(
        PURCHASES, build_rollup(ev, PURCHASES), select=["country", "AVG(total_price)"],
        where=[{"col": "type", "op": "eq", "val": "purchase"}], group_by=["country"]).collect()}
    assert got == {"XX": None, "YY": 5.0}


def test_answer_falls_back_when_an_aggregate_is_not_derivable(spark, events, scratch):
    from adevents.plans.answer import answer
    from adevents.plans.prepare import prepare

    store = prepare(events, scratch + "/store")
    spec_ = dict(select=["country", "MEDIAN(total_price)"], where=[{"col": "type", "op": "eq", "val": "purchase"}], group_by=["country"])
    assert not covers(PURCHASES, **spec_)
    result, source = answer(spark, store, **spec_)
    assert source == "events" and result.count() > 0
    # an aggregate only named in order_by must be derivable as well
    ordered = dict(select=["country"], where=[{"col": "type", "op": "eq", "val": "purchase"}], group_by=["country"],
                   order_by=[{"col": "MAX(total_price)", "dir": "desc"}])
    assert not covers(PURCHASES, **ordered)


def test_custom_rollup_is_preferred_when_smallest(spark, events, scratch):
    from adevents.operators.rollups import ROLLUPS, Rollup
    from adevents.plans.answer import answer
    from adevents.plans.prepare import prepare
    from adevents.plans.reports import SPECS

    daily = Rollup("daily", ("day", "type"), (("n", "count", "*"), ("revenue", "sum", "bid_price")))
    store = prepare(events, scratch + "/store", rollups=ROLLUPS + (daily,))
    result, source = answer(spark, store, rollups=ROLLUPS + (daily,), **SPECS["q1"])
    assert source == "daily"
    assert compare_results(result, report(events, **SPECS["q1"])).collect()[0].matched


def test_order_by_sql_style_name(events):
    r = report(events, select=["type", "COUNT(*)"], group_by=["type"], order_by=[{"col": "count_star()", "dir": "desc"}], names="sql")
    counts = [x["count_star()"] for x in r.collect()]
    assert counts == sorted(counts, reverse=True)
