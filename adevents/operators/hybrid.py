"""Reports over a range of time that a summary table kept by day covers in part.

A report for ``hour`` (or ``minute``, ``ts``) between two moments is answered
from the summary table for the whole days of the range, and from the events for
the cut first and last day.  The events of these days (two partitions per type)
are brought to the summary table's grain, united with its rows, and the report
re-aggregates both; a day comes from one side only, so nothing counts twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.functions.predicates import apply_filters
from adevents.operators.report import spec
from adevents.operators.rollups import NotCovered, Rollup, build_rollup, check_coverage, rollup_report

#: Columns that follow from the time of an event, and the last value that each has on a day.
_LAST = {
    "ts": dt.time(23, 59, 59, 999999),
    "hour": dt.time(23, 0),
    "minute": dt.time(23, 59),
}


@dataclass(frozen=True)
class Split:
    """A range of time: whole days from ``first`` to ``last`` (None: no bound), and the days that are cut."""

    first: dt.date | None
    last: dt.date | None
    cut: tuple[dt.date, ...]
    #: the conditions that give the range, and the others
    time: tuple[Mapping, ...]
    others: tuple[Mapping, ...]

    @property
    def has_whole_days(self) -> bool:
        return self.first is None or self.last is None or self.first <= self.last


def _moment(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        moment = value
    elif isinstance(value, dt.date):
        moment = dt.datetime.combine(value, dt.time())
    else:
        try:
            moment = dt.datetime.fromisoformat(str(value).strip())
        except ValueError:
            raise NotCovered(f"{value!r} is no moment") from None
    if moment.tzinfo is not None:
        raise NotCovered("moments are UTC, without a zone")
    return moment


def split_range(where: Sequence[Mapping], dims: Sequence[str]) -> Split:
    """The range that the conditions on columns of time give; raises :class:`NotCovered` without one."""
    bounds: list[tuple[str, bool, bool, dt.datetime]] = []  # column, lower, inclusive, moment
    time, others = [], []
    for cond in where:
        column, op, value = cond.get("col"), cond.get("op"), cond.get("val")
        if column not in _LAST or column in dims:
            others.append(cond)
            continue
        time.append(cond)
        if op in ("gt", "gte"):
            bounds.append((column, True, op == "gte", _moment(value)))
        elif op in ("lt", "lte"):
            bounds.append((column, False, op == "lte", _moment(value)))
        elif op == "between":
            low, high = value
            bounds += [(column, True, True, _moment(low)), (column, False, True, _moment(high))]
        else:
            raise NotCovered(f"{op} on {column} is no range")
    if not bounds:
        raise NotCovered("no range of time")
    first = last = None
    edges = set()
    day = dt.timedelta(days=1)
    for column, lower, inclusive, moment in bounds:
        date = moment.date()
        if lower:
            whole = inclusive and moment.time() == dt.time()
            edge, start = (None, date) if whole else (date, date + day)
            first = start if first is None else max(first, start)
        else:
            if not inclusive and moment.time() == dt.time():  # before the day
                edge, end = None, date - day
            elif inclusive and moment.time() >= _LAST[column]:
                edge, end = None, date
            else:
                edge, end = date, date - day
            last = end if last is None else min(last, end)
        if edge is not None:
            edges.add(edge)
    cut = tuple(sorted(d for d in edges if not _inside(d, first, last)))
    return Split(first, last, cut, tuple(time), tuple(others))


def _inside(day: dt.date, first: dt.date | None, last: dt.date | None) -> bool:
    return (first is None or day >= first) and (last is None or day <= last)


def check_hybrid(rollup: Rollup, select=None, where=None, group_by=None, order_by=None, limit=None) -> Split:
    """The range's split; raises :class:`NotCovered` where the summary table can't answer its whole days."""
    if "day" not in rollup.dims:
        raise NotCovered(f"{rollup.name} is not kept by day")
    split = split_range(where or (), rollup.dims)
    if not split.has_whole_days:
        raise NotCovered("the range has no whole day")
    check_coverage(rollup, spec(select, split.others, group_by, order_by, limit))
    return split


def hybrid_table(rollup: Rollup, table: DataFrame, events: DataFrame, split: Split) -> DataFrame:
    """Rows of the summary table's grain for the range: its whole days, and the cut days' events."""
    whole = table
    if split.first is not None:
        whole = whole.where(F.col("day") >= F.lit(split.first))
    if split.last is not None:
        whole = whole.where(F.col("day") <= F.lit(split.last))
    whole = whole.where(F.col("day").isNotNull())
    if not split.cut:
        return whole
    edges = apply_filters(events.where(F.col("day").isin(*[F.lit(d) for d in split.cut])), split.time)
    return whole.unionByName(build_rollup(edges, rollup).select(*whole.columns))


def hybrid_report(
    rollup: Rollup, table: DataFrame, events: DataFrame, select=None, where=None, group_by=None, order_by=None, limit=None, *, names: str = "plain"
) -> DataFrame:
    """Answer a report over a range of time, or raise :class:`NotCovered`."""
    split = check_hybrid(rollup, select, where, group_by, order_by, limit)
    rows = hybrid_table(rollup, table, events, split)
    return rollup_report(rollup, rows, select, split.others, group_by, order_by, limit, names=names)
