"""Answer report specs from a prepared store and write their results.

:func:`answer` uses the smallest summary table whose coverage check passes
(:func:`adevents.operators.rollups.covers`) and otherwise the partitioned
event store, so every spec gets an answer and none is answered from a
table that would drop one of its clauses.  :func:`write_reports` answers a
set of named specs and writes each result as CSV with a header.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from adevents.operators.report import clauses_of, report
from adevents.operators.hybrid import hybrid_report
from adevents.operators.rollups import ROLLUPS, NotCovered, covers, rollup_report
from adevents.plans.prepare import PreparedStore
from adevents.session import _join
from adevents.sources.results import write_result_csv


def answer(spark: SparkSession, store: PreparedStore, rollups=ROLLUPS, names: str = "plain", **clauses) -> tuple[DataFrame, str]:
    """``(result, source)``; source is a rollup name, ``"<name>+events"`` or ``"events"``.

    Of the covering summary tables built from the store's current version,
    the one with the fewest rows answers.  A range of time that cuts days is
    answered from a table kept by day and the events of the cut days
    (:mod:`adevents.operators.hybrid`).
    """
    store.sync(spark)
    built = [r for r in rollups if r.name in store.rollup_paths]
    built.sort(key=lambda x: (store.rollup_rows.get(x.name, 0), len(x.dims)))
    for r in built:
        if covers(r, **clauses):
            return rollup_report(r, store.rollup(spark, r), **clauses, names=names), r.name
    for r in built:
        try:
            result = hybrid_report(r, store.rollup(spark, r), store.events(spark), **clauses, names=names)
        except NotCovered:
            continue
        return result, f"{r.name}+events"
    return report(store.events(spark), **clauses, names=names), "events"


def answer_query(spark: SparkSession, store: PreparedStore, query: Mapping, rollups=ROLLUPS, names: str = "plain") -> tuple[DataFrame, str]:
    """:func:`answer` for a query dict (``from`` must name the events)."""
    source, clauses = clauses_of(query)
    if source != "events":
        raise ValueError(f"a prepared store answers queries on 'events', not {source!r}")
    return answer(spark, store, rollups, names=names, **clauses)


def write_reports(
    spark: SparkSession,
    store: PreparedStore,
    specs: Mapping[str, Mapping],
    out_dir: str,
    names: str = "plain",
    max_parallel: int = 1,
) -> dict[str, str]:
    """Answer each named query dict and write ``<out_dir>/<name>/`` as CSV.

    With ``max_parallel > 1`` the reports are submitted from that many
    driver threads; Spark runs their jobs side by side on the cluster
    (each report is still one independent plan).
    """

    def one(item):
        name, query = item
        result, source = answer_query(spark, store, query, names=names)
        write_result_csv(result, _join(out_dir, name))
        return name, source

    if max_parallel <= 1:
        return dict(one(item) for item in specs.items())
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        return dict(pool.map(one, specs.items()))
