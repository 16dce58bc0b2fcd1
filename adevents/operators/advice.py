"""Which summary tables to keep: a greedy choice over the lattice of grains.

A report needs the columns it groups and filters by; any summary table whose
dimensions include them answers it by reading the table's rows, and without one
the events are read.  Candidates are the reports' needs and all their unions.
Their row counts are found exactly by one aggregation over grouping sets.  Then,
as long as the row budget allows, the grain is added that saves the most rows read
per row kept, over all reports (times their weights).  The best single grain is
compared with that choice at the end, which bounds the gap to the best choice:
at least half of (1 - 1/e) of the savings that any choice within the budget has.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.operators.report import spec

Grain = tuple[str, ...]


def needed(query: Mapping) -> Grain:
    """The columns that a report groups or filters by, sorted."""
    s = spec(query["select"], query.get("where"), query.get("group_by"), query.get("order_by"), query.get("limit"))
    return tuple(sorted({*s.group_by, *(w["col"] for w in s.where)}))


def candidates(needs: Iterable[Grain]) -> list[Grain]:
    """The needs and all unions of them, small ones first."""
    found = {frozenset(n) for n in needs if n}
    while True:
        more = found | {a | b for a, b in itertools.combinations(found, 2)}
        if more == found:
            return sorted((tuple(sorted(g)) for g in found), key=lambda g: (len(g), g))
        found = more


def grain_rows(events: DataFrame, grains: Sequence[Grain]) -> dict[Grain, int]:
    """How many rows a summary table of each grain has: one scan, one row per group and grain shuffled."""
    columns = sorted({c for g in grains for c in g})
    sets = [[F.col(c) for c in g] for g in grains]
    groups = events.select(*columns).groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("grain"))
    counts = {r.grain: r["count"] for r in groups.groupBy("grain").count().collect()}  # one row per grain
    number = {g: sum((c not in g) << i for i, c in enumerate(reversed(columns))) for g in grains}
    return {g: counts.get(number[g], 0) for g in grains}


@dataclass(frozen=True)
class Choice:
    grain: Grain
    rows: int
    #: rows read less than with the grains chosen before
    saved: float


def cost(needs: Sequence[Grain], weights: Sequence[float], rows: Mapping[Grain, int], n_events: int, chosen: Iterable[Grain]) -> float:
    """Rows that all reports read, each the smallest chosen grain that has its columns, or the events."""
    chosen = list(chosen)
    best = [min([rows[g] for g in chosen if set(n) <= set(g)] + [n_events]) for n in needs]
    return sum(w * b for w, b in zip(weights, best))


def choose(needs: Sequence[Grain], weights: Sequence[float], rows: Mapping[Grain, int], n_events: int, budget: int) -> list[Choice]:
    """The greedy choice; ties fall to the smaller, then the earlier grain."""
    order = sorted(rows, key=lambda g: (rows[g], len(g), g))
    chosen: list[Choice] = []
    left = budget
    now = start = cost(needs, weights, rows, n_events, ())
    while True:
        grains = [c.grain for c in chosen]
        gains = [(now - cost(needs, weights, rows, n_events, [*grains, g]), g) for g in order if g not in grains and rows[g] <= left]
        gains = [(saved, g) for saved, g in gains if saved > 0]
        if not gains:
            break
        saved, grain = max(gains, key=lambda x: x[0] / max(rows[x[1]], 1))
        chosen.append(Choice(grain, rows[grain], saved))
        now, left = now - saved, left - rows[grain]
    single = [(start - cost(needs, weights, rows, n_events, [g]), g) for g in order if rows[g] <= budget]
    saved, grain = max(single, key=lambda x: x[0], default=(0, ()))
    return [Choice(grain, rows[grain], saved)] if saved > start - now else chosen


def advise(events: DataFrame, queries: Sequence[Mapping], budget: int, weights: Sequence[float] | None = None) -> DataFrame:
    """``nth, grain, n_rows, saved_rows`` of the grains to keep for these reports, at most ``budget`` rows in all."""
    needs = [needed(q) for q in queries]
    weights = list(weights or [1.0] * len(needs))
    grains = candidates(needs)
    rows = grain_rows(events, grains) if grains else {}
    chosen = choose(needs, weights, rows, events.count(), budget)
    out = [(i, ",".join(c.grain), c.rows, float(c.saved)) for i, c in enumerate(chosen, 1)]
    return events.sparkSession.createDataFrame(out, "nth int, grain string, n_rows long, saved_rows double")
