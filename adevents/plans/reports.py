"""The five headline reports, on events and on summary tables.

``Q1``..``Q5`` are the clause specs; ``q1``..``q5`` answer them from any
event frame (normally the partitioned store, where the ``type`` and ``day``
conditions become partition filters) and ``r1``..``r5`` from the matching
rollup.  Both paths name their columns identically, so their results can be
compared directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from adevents.operators.report import report
from adevents.operators.rollups import COUNTS, DAILY_REVENUE, PURCHASES, REVENUE, rollup_report

_IMPRESSION = {"col": "type", "op": "eq", "val": "impression"}

# The five report specs (dates fall inside the driver data).
Q1 = dict(
    select=["day", {"SUM": "bid_price"}],
    where=[_IMPRESSION],
    group_by=["day"],
)
Q2 = dict(
    select=["publisher_id", {"SUM": "bid_price"}],
    where=[
        _IMPRESSION,
        {"col": "country", "op": "eq", "val": "JP"},
        {"col": "day", "op": "between", "val": ["2024-01-20", "2024-01-23"]},
    ],
    group_by=["publisher_id"],
)
Q3 = dict(
    select=["country", {"AVG": "total_price"}],
    where=[{"col": "type", "op": "eq", "val": "purchase"}],
    group_by=["country"],
    order_by=[{"col": "AVG(total_price)", "dir": "desc"}],
)
Q4 = dict(
    select=["advertiser_id", "type", {"COUNT": "*"}],
    group_by=["advertiser_id", "type"],
    order_by=[{"col": "COUNT(*)", "dir": "desc"}],
)
Q5 = dict(
    select=["minute", {"SUM": "bid_price"}],
    where=[_IMPRESSION, {"col": "day", "op": "eq", "val": "2024-01-15"}],
    group_by=["minute"],
    order_by=[{"col": "minute", "dir": "asc"}],
)
SPECS = {"q1": Q1, "q2": Q2, "q3": Q3, "q4": Q4, "q5": Q5}
ROLLUP_OF = {"q1": DAILY_REVENUE, "q2": DAILY_REVENUE, "q3": PURCHASES, "q4": COUNTS, "q5": REVENUE}


def on_events(name: str, events: DataFrame) -> DataFrame:
    return report(events, **SPECS[name])


def on_rollup(name: str, table: DataFrame) -> DataFrame:
    return rollup_report(ROLLUP_OF[name], table, **SPECS[name])
