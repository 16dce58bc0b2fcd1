"""Registered queries: one per operator, each over the driver tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the full ``events`` table of ``sf_dir`` -- directly, through the prepared
event store and its summary tables, or through CSV parts / zip archives /
a streamed store that Spark rendered from the same rows.  Sums are rounded
to 4 places and averages / spreads to 6 so float summation order cannot
change a value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.functions.typing import type_events
from adevents.operators.compare import compare_results
from adevents.operators.report import report
from adevents.operators.rollups import COUNTS, PURCHASES, REVENUE, Rollup, rollup_report
from adevents.plans.adapter import load_ad_events, raw_events
from adevents.plans.prepare import csv_parts_for, ingested_store_for, prepared_for, zip_parts_for
from adevents.plans.reports import ROLLUP_OF, SPECS, on_events, on_rollup
from adevents.schema import EVENT_COLUMNS
from adevents.session import prepare_session
from adevents.sources.csv_parts import read_event_parts
from adevents.sources.store import read_store, row_count, store_inventory
from adevents.sources.zip_parts import read_event_zip

SUM4 = {"sum_bid_price": 4}


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    if not digits:
        return df
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_for(spark, sf_dir).events(spark)


def rollup_table(spark: SparkSession, sf_dir: str, rollup: Rollup) -> DataFrame:
    return prepared_for(spark, sf_dir).rollup(spark, rollup)


_CSV_VIEWS: dict = {}


def csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events over the CSV parts (the unprepared path).

    The lazy frame is defined once per session; every report on it parses
    the CSV text again, as a view over raw files does.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CSV_VIEWS:
        _CSV_VIEWS[key] = type_events(read_event_parts(spark, csv_parts_for(spark, sf_dir)))
    return _CSV_VIEWS[key]


def _digits(name: str) -> dict[str, int]:
    return {"q3": {"avg_total_price": 6}, "q4": {}}.get(name, SUM4)


# ---- the five reports: prepared store, summary tables, raw CSV ------------

def _on_store(name):
    def q(spark, sf_dir):
        return _rounded(on_events(name, store(spark, sf_dir)), _digits(name))

    return q


def _on_rollup(name):
    def q(spark, sf_dir):
        return _rounded(on_rollup(name, rollup_table(spark, sf_dir, ROLLUP_OF[name])), _digits(name))

    return q


def _on_csv(name):
    def q(spark, sf_dir):
        return _rounded(on_events(name, csv_events(spark, sf_dir)), _digits(name))

    return q


# ---- sources and sinks -----------------------------------------------------

def csv_roundtrip(spark, sf_dir):
    """Parts with mixed header orders read back by name and typed."""
    return csv_events(spark, sf_dir)


def zip_roundtrip(spark, sf_dir):
    """Zip archives (with __MACOSX copies to skip) read back and typed."""
    return type_events(read_event_zip(spark, zip_parts_for(spark, sf_dir)))


def incremental_ingest(spark, sf_dir):
    """S3: the store built by streaming one part per trigger."""
    return read_store(spark, ingested_store_for(spark, sf_dir))


def incremental_ingest_by_name(spark, sf_dir):
    """S3 by header name: parts in mixed column orders, streamed one per trigger."""
    return read_store(spark, ingested_store_for(spark, sf_dir, by_name=True))


def store_roundtrip(spark, sf_dir):
    """Every typed event written to and read back from the store."""
    return store(spark, sf_dir)


def store_pruned_scan(spark, sf_dir):
    """Partition filters on type/day, pushed filter on country."""
    return report(
        store(spark, sf_dir),
        select=["ts", "day", "publisher_id", "country", "bid_price"],
        where=[
            {"col": "type", "op": "eq", "val": "impression"},
            {"col": "day", "op": "between", "val": ["2024-01-10", "2024-01-12"]},
            {"col": "country", "op": "neq", "val": "BR"},
        ],
    )


def store_inventory_q(spark, sf_dir):
    """Rows per (type, day) partition."""
    return store_inventory(store(spark, sf_dir), with_files=False)


def row_count_q(spark, sf_dir):
    """Total rows in the store."""
    return row_count(store(spark, sf_dir))


# ---- projections and typing rules ------------------------------------------

def project(spark, sf_dir):
    return report(store(spark, sf_dir), select=["auction_id", "advertiser_id", "user_id", "country"])


def _typed_from_text(spark, sf_dir) -> DataFrame:
    return type_events(raw_events(load_ad_events(spark, sf_dir)))


def derive_time(spark, sf_dir):
    """Epoch-ms text -> ts and its week/day/hour/minute."""
    return _typed_from_text(spark, sf_dir).select("auction_id", "ts", "week", "day", "hour", "minute")


def clean_ids(spark, sf_dir):
    """Soft integer casts of the id columns."""
    return _typed_from_text(spark, sf_dir).select("auction_id", "advertiser_id", "publisher_id", "user_id")


def clean_prices(spark, sf_dir):
    """Empty -> NULL, strict double for the prices."""
    return _typed_from_text(spark, sf_dir).select("auction_id", "bid_price", "total_price")


def weekly_revenue(spark, sf_dir):
    return _rounded(
        report(store(spark, sf_dir), select=["week", "SUM(bid_price)"], where=[{"col": "type", "op": "eq", "val": "impression"}], group_by=["week"]),
        SUM4,
    )


def hourly_revenue(spark, sf_dir):
    return _rounded(
        report(store(spark, sf_dir), select=["hour", "SUM(bid_price)"], where=[{"col": "type", "op": "eq", "val": "impression"}], group_by=["hour"]),
        SUM4,
    )


# ---- predicates ----------------------------------------------------------------

_ROW = ["auction_id", "type", "day", "advertiser_id", "publisher_id", "bid_price", "country"]


def _filtered(where):
    def q(spark, sf_dir):
        return report(store(spark, sf_dir), select=_ROW, where=where)

    return q


FILTERS = {
    "filter_eq": [{"col": "country", "op": "eq", "val": "JP"}],
    "filter_neq": [{"col": "country", "op": "neq", "val": "US"}],
    "filter_range": [
        {"col": "bid_price", "op": "gt", "val": 10},
        {"col": "bid_price", "op": "lte", "val": 80},
        {"col": "advertiser_id", "op": "gte", "val": "3"},
        {"col": "advertiser_id", "op": "lt", "val": 15},
    ],
    "filter_between": [{"col": "minute", "op": "between", "val": ["2024-01-05 00:00", "2024-01-06 12:00"]}],
    "filter_in": [{"col": "country", "op": "in", "val": ["US", "JP"]}],
    "filter_hours": [
        {"col": "hour", "op": "between", "val": ["2024-01-05 06:00:00", "2024-01-05 18:00:00"]},
        {"col": "type", "op": "in", "val": ["impression", "click", "purchase"]},
    ],
    "filter_and": [
        {"col": "type", "op": "eq", "val": "impression"},
        {"col": "country", "op": "in", "val": ["DE", "BR", "IN"]},
        {"col": "day", "op": "between", "val": ["2024-01-03", "2024-01-25"]},
        {"col": "publisher_id", "op": "gte", "val": 20},
    ],
    "filter_fraction": [
        {"col": "advertiser_id", "op": "lt", "val": 12.5},
        {"col": "advertiser_id", "op": "gte", "val": "2.5"},
        {"col": "publisher_id", "op": "between", "val": [-0.5, 60.25]},
        {"col": "advertiser_id", "op": "neq", "val": 7.5},
    ],
    "filter_wide": [
        {"col": "advertiser_id", "op": "lt", "val": 3_000_000_000},
        {"col": "publisher_id", "op": "gt", "val": -3e9},
        {"col": "user_id", "op": "lte", "val": 400},
    ],
}


# ---- aggregations ----------------------------------------------------------------

def global_agg(spark, sf_dir):
    r = report(
        store(spark, sf_dir),
        select=[{"SUM": "bid_price", "AVG": "bid_price", "MIN": "bid_price", "MAX": "bid_price", "COUNT": "bid_price"}, "COUNT(*)"],
    )
    return _rounded(r, {"sum_bid_price": 4, "avg_bid_price": 6})


def agg_misc(spark, sf_dir):
    r = report(
        store(spark, sf_dir),
        select=[
            "country",
            {"MIN": "bid_price", "MAX": "bid_price", "STDDEV": "bid_price", "VARIANCE": "bid_price", "MEDIAN": "bid_price"},
            "COUNT(DISTINCT user_id)",
            {"MEDIAN": "total_price"},
        ],
        group_by=["country"],
    )
    six = {c: 6 for c in ("stddev_bid_price", "variance_bid_price", "median_bid_price", "median_total_price")}
    return _rounded(r, six)


def agg_variants(spark, sf_dir):
    """Population spreads, DISTINCT sums and counts, the MEAN alias."""
    r = report(
        store(spark, sf_dir),
        select=[
            "type",
            {"STDDEV_POP": "bid_price", "VAR_POP": "bid_price", "MEAN": "total_price"},
            "SUM(DISTINCT advertiser_id)",
            "COUNT(DISTINCT country)",
        ],
        group_by=["type"],
    )
    return _rounded(r, {"stddev_pop_bid_price": 6, "var_pop_bid_price": 6, "avg_total_price": 6})


def distinct_pairs(spark, sf_dir):
    return report(store(spark, sf_dir), select=["advertiser_id", "type"], group_by=["advertiser_id", "type"])


def rollup_counts(spark, sf_dir):
    return rollup_table(spark, sf_dir, COUNTS).groupBy("advertiser_id", "type").agg(F.sum("event_count").alias("event_count"))


def rollup_revenue(spark, sf_dir):
    return _rounded(rollup_table(spark, sf_dir, REVENUE), {"total_revenue": 4})


def rollup_purchases(spark, sf_dir):
    table = rollup_table(spark, sf_dir, PURCHASES).groupBy("country")
    sums = [F.sum(c).alias(c) for c in ("sum_of_price", "count_of_purchases")]
    return _rounded(table.agg(*sums), {"sum_of_price": 4})


# ---- answers: summary table or events ------------------------------------------

def _answered(spark, sf_dir, **clauses) -> DataFrame:
    from adevents.plans.answer import answer

    result, source = answer(spark, prepared_for(spark, sf_dir), **clauses)
    return result.withColumn("source", F.lit(source))


def answer_routed(spark, sf_dir):
    """The covering summary table with the fewest rows answers."""
    where = [{"col": "type", "op": "eq", "val": "impression"}, {"col": "country", "op": "in", "val": ["US", "DE"]}]
    r = _answered(spark, sf_dir, select=["day", "SUM(bid_price)"], where=where, group_by=["day"])
    return _rounded(r, SUM4)


def answer_fallback(spark, sf_dir):
    """No summary table covers the filter, so the events answer."""
    where = [{"col": "type", "op": "eq", "val": "impression"}, {"col": "user_id", "op": "lt", "val": 500}]
    r = _answered(spark, sf_dir, select=["day", "SUM(bid_price)"], where=where, group_by=["day"])
    return _rounded(r, SUM4)


def answer_empty_count(spark, sf_dir):
    """A count over no stored rows is 0."""
    return _answered(spark, sf_dir, select=["COUNT(*)"], where=[{"col": "type", "op": "eq", "val": "no such type"}])


def reload_day(spark, sf_dir):
    """One (type, day) of a store is replaced, all others stay."""
    from adevents.session import _join, scratch_path
    from adevents.sources.store import write_store

    path = _join(scratch_path(spark, "reload"), "events")
    write_store(load_ad_events(spark, sf_dir), path)
    reloaded = report(
        load_ad_events(spark, sf_dir),
        select=["*"],
        where=[
            {"col": "type", "op": "eq", "val": "click"},
            {"col": "day", "op": "eq", "val": "2024-01-10"},
            {"col": "advertiser_id", "op": "lt", "val": 7.5},
        ],
    )
    write_store(reloaded, path, replace="partitions")
    return store_inventory(read_store(spark, path), with_files=False)


def view_report(spark, sf_dir):
    """The store as a named view, queried with SQL."""
    from adevents.sources.store import register_events

    register_events(store(spark, sf_dir), "ad_events_view")
    return spark.sql("SELECT type, COUNT(*) AS n_rows, COUNT(DISTINCT country) AS n_countries FROM ad_events_view GROUP BY type")


def scalar_items(spark, sf_dir):
    """Scalar functions selected and grouped by."""
    return report(
        store(spark, sf_dir),
        select=[{"LOWER": "country"}, "MONTH(day)", {"LENGTH": "type"}, "COUNT(*)"],
        group_by=["LOWER(country)", {"MONTH": "day"}, "LENGTH(type)"],
    )


# ---- summary tables: snapshots, streams, parts of days, mergeable measures -------

_IMPRESSIONS = [{"col": "type", "op": "eq", "val": "impression"}]
_DAYS = {"col": "day", "op": "between", "val": ["2024-01-04", "2024-01-22"]}
_HOURS = {"col": "hour", "op": "between", "val": ["2024-01-05 06:00:00", "2024-01-20 17:00:00"]}


def rollup_snapshot(spark, sf_dir):
    """A store in two writes; the second one's days are refreshed, and a refresh that meets a write lists nothing."""
    from adevents.operators.rollups import DAILY_REVENUE
    from adevents.plans.answer import answer
    from adevents.plans.prepare import PreparedStore, build_folders, prepare, refresh_rollups
    from adevents.session import scratch_path
    from adevents.sources import manifest
    from adevents.sources.store import write_store

    events = load_ad_events(spark, sf_dir)
    late = F.coalesce(F.col("day") >= F.lit("2024-01-20").cast("date"), F.lit(False))
    prepared = prepare(events.where(~late), scratch_path(spark, "snapshot"), rollups=(DAILY_REVENUE,))
    slow = PreparedStore(prepared.root)  # a refresh that begins before the second write and ends after it
    version = slow.sync(spark)
    folders = build_folders(spark, slow, slow.events(spark), (DAILY_REVENUE,), None, {})
    write_store(events.where(late), prepared.events_path, replace="none")
    try:
        manifest.add_rollups(spark, slow.events_path, version, folders, slow.entry)
        raise RuntimeError("a refresh of an old version was listed")
    except manifest.Conflict:
        pass
    days = [r.day for r in events.where(late).select("day").distinct().collect()]
    refresh_rollups(spark, prepared, days, rollups=(DAILY_REVENUE,))
    result, source = answer(spark, prepared, select=["day", "SUM(bid_price)"], where=_IMPRESSIONS, group_by=["day"])
    return _rounded(result, SUM4).withColumn("source", F.lit(source))


def streamed_rollups(spark, sf_dir):
    """A summary table kept up by the stream, after a batch that came twice."""
    from adevents.operators.rollups import DAILY_REVENUE
    from adevents.plans.prepare import streamed_rollups_for

    return _rounded(streamed_rollups_for(spark, sf_dir).rollup(spark, DAILY_REVENUE), {"total_revenue": 4})


def answer_hybrid(spark, sf_dir):
    """Whole days from a summary table, the cut first and last day from the events."""
    r = _answered(spark, sf_dir, select=["country", "SUM(bid_price)"], where=[*_IMPRESSIONS, _HOURS], group_by=["country"])
    return _rounded(r, SUM4)


def _from_mergeable(spark, sf_dir, rollup, **clauses):
    from adevents.plans.prepare import mergeable_for

    return rollup_report(rollup, mergeable_for(spark, sf_dir).rollup(spark, rollup), **clauses)


def distinct_from_rollup(spark, sf_dir):
    """COUNT(DISTINCT id) from bitmaps kept by day."""
    from adevents.operators.rollups import USERS

    return _from_mergeable(spark, sf_dir, USERS, select=["country", "COUNT(DISTINCT user_id)"], where=[_DAYS], group_by=["country"])


def spread_from_rollup(spark, sf_dir):
    """Spreads from moments kept by day."""
    from adevents.operators.rollups import BIDS

    items = {"STDDEV": "bid_price", "VARIANCE": "total_price", "STDDEV_POP": "total_price", "VAR_POP": "bid_price"}
    r = _from_mergeable(spark, sf_dir, BIDS, select=["advertiser_id", items], where=[_DAYS], group_by=["advertiser_id"])
    return _rounded(r, {c: 6 for c in r.columns[1:]})


def quantile_from_rollup(spark, sf_dir):
    """Ranks and bounds of a quantile from histograms kept by day."""
    from adevents.operators.rollups import BID_VALUES, rollup_quantile
    from adevents.plans.prepare import mergeable_for

    table = mergeable_for(spark, sf_dir).rollup(spark, BID_VALUES)
    return rollup_quantile(BID_VALUES, table, 0.9, ["country"], [*_IMPRESSIONS, _DAYS])


def compare_keyed_q(spark, sf_dir):
    """U4: revenue by advertiser and country over two ranges of days, compared by key within 30 %."""
    from adevents.operators.compare import compare_keyed

    def side(days, extra=()):
        where = [*_IMPRESSIONS, {"col": "day", "op": "between", "val": days}, *extra]
        clauses = dict(select=["advertiser_id", "country", "SUM(bid_price)", "COUNT(*)"], where=where, group_by=["advertiser_id", "country"])
        return _rounded(report(store(spark, sf_dir), **clauses), SUM4)

    a = side(["2024-01-01", "2024-01-15"], [{"col": "advertiser_id", "op": "neq", "val": 3}])
    b = side(["2024-01-16", "2024-01-31"], [{"col": "country", "op": "neq", "val": "BR"}])
    found = compare_keyed(a, b, ["advertiser_id", "country"], absolute=10, relative=0.3)
    return _rounded(found, {"sum_bid_price_diff": 4, "sum_bid_price_rel": 6, "count_star_rel": 6})


def quarantine(spark, sf_dir):
    """Every line of damaged parts, good or set aside with a reason."""
    from adevents.plans.prepare import damaged_parts_for
    from adevents.sources.quarantine import read_with_quarantine

    good, bad = read_with_quarantine(spark, damaged_parts_for(spark, sf_dir), "part-*.txt")
    lines = bad.select(F.get(F.split("line", ","), F.lit(2)).alias("auction_id"), "reason")
    return good.select("auction_id", F.lit(None).cast("string").alias("reason")).unionByName(lines)


def advised_rollups(spark, sf_dir):
    """The grains to keep for the five reports, at most as many rows as a fifth of the events."""
    from adevents.operators.advice import advise

    events = store(spark, sf_dir)
    return advise(events, list(SPECS.values()), events.count() // 5)


_BY_DIMENSION = {
    "country": {"col": "country", "op": "eq", "val": "JP"},
    "publisher_id": {"col": "publisher_id", "op": "between", "val": [20, 29]},
    "minute": {"col": "minute", "op": "between", "val": ["2024-01-15 06:00", "2024-01-15 11:59"]},
}


def clustered_scan(spark, sf_dir):
    """A filter on each dimension of a store in space-filling order."""
    from adevents.plans.prepare import clustered_for

    events = read_store(spark, clustered_for(spark, sf_dir))
    columns = ["auction_id", "day", "country", "publisher_id", "minute", "bid_price"]
    found = [report(events, select=columns, where=[w]).withColumn("dimension", F.lit(d)) for d, w in _BY_DIMENSION.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


def input_guards(spark, sf_dir):
    """A folder without parts and a place without a store raise; parts are counted."""
    from adevents.plans.prepare import open_prepared
    from adevents.session import scratch_path

    def outcome(run) -> str:
        try:
            run()
            return "opened"
        except FileNotFoundError:
            return "not found"

    nowhere = scratch_path(spark, "nowhere")
    parts = csv_events(spark, sf_dir)
    rows = [
        ("no parts", outcome(lambda: read_event_parts(spark, prepared_for(spark, sf_dir).events_path))),
        ("no store", outcome(lambda: open_prepared(spark, nowhere))),
        ("store", outcome(lambda: open_prepared(spark, prepared_for(spark, sf_dir).root))),
    ]
    cases = spark.createDataFrame(rows, "case string, outcome string").withColumn("n_rows", F.lit(None).cast("long"))
    return cases.unionByName(parts.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("parts").alias("case"), F.lit("opened").alias("outcome"), "n_rows"))


# ---- sort / limit ----------------------------------------------------------------

def topk_bids(spark, sf_dir):
    return report(
        store(spark, sf_dir),
        select=["auction_id", "advertiser_id", "bid_price"],
        where=[{"col": "type", "op": "eq", "val": "impression"}],
        order_by=[{"col": "bid_price", "dir": "desc"}, {"col": "auction_id"}],
        limit=20,
    )


def topk_advertisers(spark, sf_dir):
    return report(
        store(spark, sf_dir),
        select=["advertiser_id", "COUNT(*)"],
        where=[{"col": "type", "op": "eq", "val": "impression"}],
        group_by=["advertiser_id"],
        order_by=[{"col": "COUNT(*)", "dir": "desc"}, {"col": "advertiser_id"}],
        limit=5,
    )


def adhoc_report(spark, sf_dir):
    r = report(
        store(spark, sf_dir),
        select=["country", "type", {"SUM": "bid_price", "COUNT": "*"}, "AVG(total_price)", "MAX(minute)"],
        where=[{"col": "day", "op": "between", "val": ["2024-01-03", "2024-01-27"]}, {"col": "type", "op": "neq", "val": "error"}],
        group_by=["country", "type"],
        order_by=[{"col": "COUNT(*)", "dir": "desc"}, {"col": "country"}, {"col": "type"}],
        limit=10,
    )
    return _rounded(r, {"sum_bid_price": 4, "avg_total_price": 6})


# ---- set operations ----------------------------------------------------------------

def compare_q3(spark, sf_dir):
    """Q3 from the events against Q3 from the purchase rollup."""
    a = on_events("q3", store(spark, sf_dir))
    b = on_rollup("q3", rollup_table(spark, sf_dir, PURCHASES))
    return compare_results(a, b, digits=6)


def q1_sql_names(spark, sf_dir):
    """Q1 from the revenue rollup with the default SQL column names."""
    r = rollup_report(REVENUE, rollup_table(spark, sf_dir, REVENUE), **SPECS["q1"], names="sql")
    return _rounded(r, {"sum(bid_price)": 4})


def verify_reports(spark, sf_dir):
    """U4 end to end: the five reports written twice and compared as files.

    Routed answers (covering summary tables) and baseline answers (raw CSV
    parts, parsed on the fly) are written as CSV result folders in the
    shared scratch space, then every pair is read back and compared as
    row sets with numeric text rounded to six places.
    """
    from adevents.operators.compare import compare_result_folders
    from adevents.plans.answer import write_reports
    from adevents.session import _join, scratch_path
    from adevents.sources.results import write_result_csv

    prepared = prepared_for(spark, sf_dir)
    out = scratch_path(spark, "verify")
    queries_ = {name: {**spec_, "from": "events"} for name, spec_ in SPECS.items()}
    write_reports(spark, prepared, queries_, _join(out, "routed"))
    baseline = csv_events(spark, sf_dir)
    for name, spec_ in SPECS.items():
        write_result_csv(report(baseline, **spec_), _join(out, "baseline", name))
    return compare_result_folders(spark, _join(out, "baseline"), _join(out, "routed"), [*SPECS, "missing"])


def queries() -> dict:
    prepare = {
        "csv_roundtrip": csv_roundtrip,
        "zip_roundtrip": zip_roundtrip,
        "incremental_ingest": incremental_ingest,
        "incremental_ingest_by_name": incremental_ingest_by_name,
        "store_roundtrip": store_roundtrip,
        "store_pruned_scan": store_pruned_scan,
        "store_inventory": store_inventory_q,
        "row_count": row_count_q,
    }
    names = {"q1": "daily_revenue", "q2": "publisher_revenue", "q3": "avg_purchase", "q4": "event_counts", "q5": "minute_revenue"}
    out: dict = {}
    for q, label in names.items():
        out[f"{q}_{label}"] = _on_store(q)
    for q, label in names.items():
        out[f"r{q[1]}_{label}"] = _on_rollup(q)
    for q, label in names.items():
        out[f"csv_{q}_{label}"] = _on_csv(q)
    out.update(prepare)
    out.update(
        {
            "project": project,
            "derive_time": derive_time,
            "clean_ids": clean_ids,
            "clean_prices": clean_prices,
            "weekly_revenue": weekly_revenue,
            "hourly_revenue": hourly_revenue,
            "global_agg": global_agg,
            "agg_misc": agg_misc,
            "agg_variants": agg_variants,
            "distinct_pairs": distinct_pairs,
            "rollup_counts": rollup_counts,
            "rollup_revenue": rollup_revenue,
            "rollup_purchases": rollup_purchases,
            "topk_bids": topk_bids,
            "topk_advertisers": topk_advertisers,
            "adhoc_report": adhoc_report,
            "compare_q3": compare_q3,
            "verify_reports": verify_reports,
            "q1_sql_names": q1_sql_names,
            "answer_routed": answer_routed,
            "answer_fallback": answer_fallback,
            "answer_empty_count": answer_empty_count,
            "reload_day": reload_day,
            "view_report": view_report,
            "scalar_items": scalar_items,
            "rollup_snapshot": rollup_snapshot,
            "streamed_rollups": streamed_rollups,
            "answer_hybrid": answer_hybrid,
            "distinct_from_rollup": distinct_from_rollup,
            "spread_from_rollup": spread_from_rollup,
            "quantile_from_rollup": quantile_from_rollup,
            "compare_keyed": compare_keyed_q,
            "quarantine": quarantine,
            "clustered_scan": clustered_scan,
            "input_guards": input_guards,
            "advised_rollups": advised_rollups,
        }
    )
    for key, where in FILTERS.items():
        out[key] = _filtered(where)
    return {k: _with_session(fn) for k, fn in out.items()}


def _with_session(fn):
    """Apply the session settings (UTC buckets, checkpoint folder) first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return _on_store("q1")(spark, sf_dir)


__all__ = ["queries", "flagship", "EVENT_COLUMNS", "SPECS"]
