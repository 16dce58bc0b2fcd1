from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import os

from adevents.operators.report import report
from adevents.schema import EVENT_COLUMNS
from adevents.sources.store import read_store, store_inventory, write_store


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_layout_and_roundtrip(spark, events, scratch):
    write_store(events, scratch)
    dirs = sorted(d for d in os.listdir(scratch) if d.startswith("type="))
    assert "type=impression" in dirs and "type=purchase" in dirs
    assert all(x.startswith("day=") for x in os.listdir(os.path.join(scratch, "type=impression")))
    back = read_store(spark, scratch)
    assert back.columns == list(EVENT_COLUMNS)
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0


def test_partition_and_pushed_filters(spark, events, scratch):
    write_store(events, scratch)
    r = report(
        read_store(spark, scratch),
        select=["publisher_id", "SUM(bid_price)"],
        where=[
            {"col": "type", "op": "eq", "val": "impression"},
            {"col": "day", "op": "between", "val": ["2024-01-02", "2024-01-03"]},
            {"col": "country", "op": "eq", "val": "JP"},
        ],
        group_by=["publisher_id"],
    )
    plan = _plan(r)
    assert "PartitionFilters: [isnotnull(type" in plan and "(type#" in plan
    assert "day#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(country), EqualTo(country,JP)]" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read_schema == "struct<publisher_id:int,bid_price:double,country:string>"


def test_inventory_counts_rows_and_files(spark, events, scratch):
    write_store(events, scratch)
    inv = store_inventory(read_store(spark, scratch)).collect()
    assert sum(r.n_rows for r in inv) == events.count()
    assert all(r.n_files >= 1 for r in inv)


def test_reload_one_day_replaces_only_that_day(spark, events, scratch):
    write_store(events, scratch)
    day = events.where("day = '2024-01-02'")
    write_store(day, scratch, replace="partitions")
    assert read_store(spark, scratch).count() == events.count()


def test_named_view_answers_sql(spark, events, scratch):
    from adevents.operators.compare import compare_results
    from adevents.sources.store import register_events

    write_store(events, scratch)
    register_events(read_store(spark, scratch), "events_view")
    via_sql = spark.sql("SELECT day, SUM(bid_price) AS sum_bid_price FROM events_view WHERE type = 'impression' GROUP BY day")
    via_report = report(read_store(spark, scratch), select=["day", "SUM(bid_price)"], where=[{"col": "type", "op": "eq", "val": "impression"}], group_by=["day"])
    assert compare_results(via_sql, via_report).collect()[0].matched


def test_missing_store_raises(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_store(spark, scratch + "/nowhere").count()


def test_reopen_prepared_store(spark, events, scratch):
    import pytest

    from adevents.plans.answer import answer_query
    from adevents.plans.prepare import open_prepared, prepare
    from adevents.plans.reports import SPECS

    prepare(events, scratch + "/p")
    again = open_prepared(spark, scratch + "/p")
    assert sorted(again.rollup_paths) == ["counts", "daily_revenue", "purchases", "revenue"]
    result, source = answer_query(spark, again, {**SPECS["q3"], "from": "events"})
    assert source == "purchases" and result.count() > 0
    with pytest.raises(FileNotFoundError):
        open_prepared(spark, scratch + "/nothing")


def test_null_partition_values_roundtrip(spark, scratch):
    from adevents.functions.typing import type_events
    from adevents.schema import RAW_SCHEMA

    raw = spark.createDataFrame(
        [
            ("oops", "impression", "a1", "1", "2", "0.5", "3", None, "US"),
            ("1717200000000", None, "a2", "1", "2", "0.5", "3", None, "US"),
            ("1717200000000", "impression", "a3", "1", "2", "0.5", "3", None, "US"),
        ],
        RAW_SCHEMA,
    )
    write_store(type_events(raw), scratch)
    back = {r.auction_id: r for r in read_store(spark, scratch).collect()}
    assert back["a1"].day is None and back["a1"].type == "impression"
    assert back["a2"].type is None and str(back["a2"].day) == "2024-06-01"
    assert back["a3"].bid_price == 0.5


EVENT = "2024-06-01 10:00:00", "impression", 0.5


def _events(spark, rows):
    """Typed events of ``(ts text, type, bid price)`` rows."""
    from adevents.functions.typing import type_events
    from adevents.schema import RAW_SCHEMA

    raw = []
    for i, (ts, kind, price) in enumerate(rows):
        millis = None if ts is None else str(int(dt.datetime.fromisoformat(ts + "+00:00").timestamp() * 1000))
        raw.append((millis, kind, f"a{i}", "1", "2", str(price), "3", None, "US"))
    return type_events(spark.createDataFrame(raw, RAW_SCHEMA))


def _revenue(spark, store):
    from adevents.plans.answer import answer

    result, source = answer(
        spark, store, select=["day", "SUM(bid_price)"], where=[{"col": "type", "op": "eq", "val": "impression"}], group_by=["day"]
    )
    return {str(r.day): r.sum_bid_price for r in result.collect()}, source


def test_summary_tables_are_never_stale(spark, scratch):
    from adevents.plans.answer import answer
    from adevents.plans.prepare import open_prepared, prepare, refresh_rollups

    store = prepare(_events(spark, [EVENT, ("2024-06-02 10:00:00", "impression", 1.4), (None, "impression", 9.0)]), scratch)
    assert _revenue(spark, store) == ({"2024-06-01": 0.5, "2024-06-02": 1.4, "None": 9.0}, "daily_revenue")
    write_store(_events(spark, [EVENT]), store.events_path, replace="none")
    assert _revenue(spark, store) == ({"2024-06-01": 1.0, "2024-06-02": 1.4, "None": 9.0}, "events")
    refresh_rollups(spark, store, ["2024-06-01"])
    assert _revenue(spark, store) == ({"2024-06-01": 1.0, "2024-06-02": 1.4, "None": 9.0}, "daily_revenue")
    # days without rows leave the summary tables
    write_store(_events(spark, [EVENT, EVENT]), store.events_path)
    refresh_rollups(spark, open_prepared(spark, scratch), ["2024-06-02", None])
    assert _revenue(spark, store) == ({"2024-06-01": 1.0}, "daily_revenue")
    # a count over no rows is 0 from a summary table too
    none, source = answer(spark, store, select=["COUNT(*)"], where=[{"col": "type", "op": "eq", "val": "nothing"}])
    assert source == "counts" and none.collect()[0].count_star == 0


def test_a_refresh_by_days_reads_only_those_days(spark, events, scratch):
    from adevents.operators.rollups import ROLLUPS, build_rollup
    from adevents.plans.prepare import _on_days

    write_store(events, scratch)
    for r in ROLLUPS:
        table = build_rollup(read_store(spark, scratch).where(_on_days(["2024-01-03"])), r)
        assert "PartitionFilters: [" in (plan := table._jdf.queryExecution().executedPlan().toString())
        assert "2024-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_broken_off_write_is_no_store(spark, events, scratch):
    import pytest

    from adevents.plans.prepare import open_prepared, prepare

    store = prepare(events.limit(50), scratch)
    bad = events.limit(50).withColumn("auction_id", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        write_store(bad, store.events_path)
    with pytest.raises(FileNotFoundError):
        open_prepared(spark, scratch)


def test_non_local_masters_need_a_shared_folder(monkeypatch):
    import pytest

    from adevents import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
