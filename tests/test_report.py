from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adevents.operators.quantiles import exact_median
from adevents.operators.report import report


def test_projection_keeps_select_order(events):
    r = report(events, select=["country", "auction_id"])
    assert r.columns == ["country", "auction_id"]
    assert r.count() == events.count()


def test_star_selects_everything(events):
    assert report(events, select=["*"]).columns == events.columns


def test_global_aggregate_names(events):
    r = report(events, select=[{"SUM": "bid_price", "COUNT": "*"}, "MAX(day)"])
    assert r.columns == ["sum_bid_price", "count_star", "max_day"]
    row = r.collect()[0]
    assert row.count_star == events.count()


def test_group_by_without_functions_is_distinct(events):
    r = report(events, select=["type"], group_by=["type", "country"])
    assert r.count() == events.select("type", "country").distinct().count()


def test_order_by_aggregate_text_desc_nulls_last(events):
    r = report(
        events,
        select=["country", {"AVG": "total_price"}],
        where=[{"col": "type", "op": "eq", "val": "purchase"}],
        group_by=["country"],
        order_by=[{"col": "AVG(total_price)", "dir": "desc"}],
    ).collect()
    values = [x.avg_total_price for x in r]
    assert values == sorted(values, reverse=True)


def test_nulls_sort_last_both_directions(events):
    for d in ("asc", "desc"):
        rows = report(events, select=["country"], group_by=["country"], order_by=[{"col": "country", "dir": d}]).collect()
        assert rows[-1].country is None


def test_order_by_aggregate_not_selected(events):
    r = report(
        events,
        select=["advertiser_id"],
        group_by=["advertiser_id"],
        order_by=[{"col": "COUNT(*)", "dir": "desc"}, {"col": "advertiser_id"}],
        limit=3,
    )
    assert r.columns == ["advertiser_id"]
    top = events.groupBy("advertiser_id").count().orderBy("count", "advertiser_id", ascending=[False, True]).limit(3)
    assert [x.advertiser_id for x in r.collect()] == [x.advertiser_id for x in top.collect()]


def test_order_plain_projection_by_unselected_column(events):
    r = report(events, select=["auction_id"], order_by=[{"col": "ts"}], limit=1).collect()
    first = events.orderBy("ts").limit(1).collect()[0]
    assert r[0].auction_id == first.auction_id


def test_limit_none_is_all_and_zero_is_empty(events):
    spec = dict(select=["advertiser_id"], group_by=["advertiser_id"])
    assert report(events, **spec).count() == events.select("advertiser_id").distinct().count()
    assert report(events, **spec, limit=0).count() == 0
    assert report(events, **spec, limit=4).count() == 4


def test_count_distinct_text(events):
    r = report(events, select=["COUNT(DISTINCT user_id)"]).collect()[0]
    assert r.count_distinct_user_id == events.select("user_id").distinct().where("user_id IS NOT NULL").count()


def test_bare_column_must_be_grouped(events):
    with pytest.raises(ValueError, match="neither grouped nor aggregated"):
        report(events, select=["country", "SUM(bid_price)"])


def test_unknown_function_and_column(events):
    with pytest.raises(ValueError, match="unsupported aggregate"):
        report(events, select=[{"FOO": "bid_price"}])
    with pytest.raises(ValueError, match="unknown columns"):
        report(events, select=["nope"])


def test_topk_is_bounded_in_plan(events):
    r = report(events, select=["auction_id", "bid_price"], order_by=[{"col": "bid_price", "dir": "desc"}], limit=5)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_aggregation_is_partial_before_shuffle(events):
    r = report(events, select=["day", "SUM(bid_price)"], group_by=["day"])
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_median_matches_pandas(events):
    got = report(events, select=["country", "MEDIAN(bid_price)"], group_by=["country"]).toPandas()
    pdf = events.select("country", "bid_price").toPandas()
    want = pdf.groupby("country", dropna=False)["bid_price"].median()
    for row in got.itertuples():
        key = row.country if row.country is not None else np.nan
        exp = want[key] if row.country is not None else want[want.index.isna()].iloc[0]
        assert (np.isnan(exp) and row.median_bid_price is None) or row.median_bid_price == pytest.approx(exp)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_exact_median_property(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "x", "m").collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for g, grp in pdf.groupby("g", dropna=False):
        key = None if (g is None or (isinstance(g, float) and np.isnan(g))) else g
        vals = grp["x"].dropna().to_numpy(dtype=float)
        if len(vals) == 0:
            assert got[key] is None
            continue
        vals.sort()
        lo, hi = vals[(len(vals) - 1) // 2], vals[len(vals) // 2]
        assert got[key] == lo * 0.5 + hi * 0.5


def test_global_median_with_other_aggregates(events):
    r = report(events, select=["MEDIAN(bid_price)", "SUM(bid_price)", "COUNT(*)"]).collect()
    assert len(r) == 1
    pdf = events.select("bid_price").toPandas()
    assert r[0].median_bid_price == pytest.approx(pdf["bid_price"].median())
    assert r[0].sum_bid_price == pytest.approx(pdf["bid_price"].sum())
    assert r[0].count_star == len(pdf)


def test_sort_has_tie_breakers(events):
    grouped = report(events, select=["type", "COUNT(*)"], group_by=["type"], order_by=[{"col": "COUNT(*)", "dir": "desc"}])
    plan = grouped._jdf.queryExecution().optimizedPlan().toString()
    assert "type#" in plan.split("Sort [")[1].split("]")[0]
    plain = report(events, select=["type", "auction_id"], order_by=[{"col": "type"}])
    assert "xxhash64" in plain._jdf.queryExecution().optimizedPlan().toString()


def test_several_medians_share_one_selection(events):
    r = report(events, select=["country", "MEDIAN(bid_price)", "MEDIAN(total_price)", "MEDIAN(advertiser_id)"], group_by=["country"])
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 5  # one selection (5 windows), not one per column
    pdf = events.select("country", "bid_price", "total_price", "advertiser_id").toPandas()
    want = pdf.groupby("country", dropna=False).median()
    for row in r.collect():
        exp = want.loc[row.country] if row.country is not None else want[want.index.isna()].iloc[0]
        for col in ("bid_price", "total_price", "advertiser_id"):
            got = getattr(row, f"median_{col}")
            assert (got is None and np.isnan(exp[col])) or got == pytest.approx(exp[col])


def test_median_shuffles_no_raw_rows_and_spreads_a_hot_group(spark, scratch):
    # one group with a third of many distinct values, and NaN, -0.0, NULL and ties elsewhere
    rows = [("hot", float(i * 7919 % 10007)) for i in range(3000)] + [("z", x) for x in (-0.0, 0.0, None, float("nan"), 3.0)]
    rows += [("n", None), (None, 1.0), (None, 2.0)] + [(f"g{i}", float(i)) for i in range(500)]
    spark.createDataFrame(rows, "g string, x double").write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    hot = sorted(x for g, x in rows if g == "hot")
    m = exact_median(stored, ["g"], "x", "m")
    got = {r.g: r.m for r in m.collect()}
    assert got["hot"] == (hot[1499] + hot[1500]) / 2 and got["z"] == 1.5 and got["n"] is None and got[None] == 1.5 and got["g7"] == 7.0
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert scratch not in plan  # the raw rows were read once, for the counts


def test_query_dicts_with_from(events):
    from adevents.operators.report import report_query
    from adevents.plans.reports import SPECS

    for name, spec_ in SPECS.items():
        q = {**spec_, "from": "events"}
        assert report_query(q, {"events": events}).columns == report(events, **spec_).columns
    with pytest.raises(ValueError, match="unknown query keys"):
        report_query({"select": ["day"], "having": []}, {"events": events})
    with pytest.raises(ValueError, match="unknown table"):
        report_query({"select": ["day"], "from": "clicks"}, {"events": events})


def test_sql_style_names(events):
    from adevents.operators.rollups import COUNTS, build_rollup, rollup_report
    from adevents.plans.reports import SPECS

    r = report(events, **SPECS["q1"], names="sql")
    assert r.columns == ["day", "sum(bid_price)"]
    r4 = report(events, **SPECS["q4"], names="sql", limit=3)
    assert r4.columns == ["advertiser_id", "type", "count_star()"]
    counts = [x["count_star()"] for x in r4.collect()]
    assert counts == sorted(counts, reverse=True)
    rr = rollup_report(COUNTS, build_rollup(events, COUNTS), **SPECS["q4"], names="sql")
    assert rr.columns == r4.columns
    d = report(events, select=["COUNT(DISTINCT user_id)"], names="sql")
    assert d.columns == ["count(DISTINCT user_id)"]
    with pytest.raises(ValueError):
        report(events, select=["day"], names="fancy")


def test_approx_count_distinct_is_close(events):
    r = report(events, select=["type", "APPROX_COUNT_DISTINCT(user_id)", "COUNT(DISTINCT user_id)"], group_by=["type"]).collect()
    for row in r:
        exact = row.count_distinct_user_id
        assert abs(row.approx_count_distinct_user_id - exact) <= max(2, 0.1 * exact)
