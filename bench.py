"""Benchmark the five headline reports.

Prepares the event store and summary tables from ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]`` (default 8), then times
each report three ways, after three warm-up passes (``$BENCH_RUNS`` sets fewer runs):

* ``qN_rollup`` -- answered from the covering summary table (the prepared,
  routed path; its total is the headline metric, comparable with the
  reference's "optimised" total);
* ``qN_store``  -- answered from the partitioned event store (pruned scan);
* ``qN_csv``    -- answered from the raw CSV parts, parsed on every run
  (the unprepared baseline path).

Each timing is the median of five runs.  ``qN_<path>`` is end to end:
building the DataFrame from the report spec plus ``collect()``.
``exec_<path>_total`` counts only ``collect()`` (optimise, plan, execute,
fetch) of a freshly built DataFrame -- the boundary at which the
reference's published timings start, after its query text is assembled.
The headline ``value`` is the end-to-end total of the summary-table path;
``concurrent_rollup_wall`` is the wall time of the same five reports
submitted together from five driver threads.
Prints one JSON line on stdout; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from adevents.plans import catalog
from adevents.plans.prepare import csv_parts_for, prepared_for
from adevents.session import get_session

RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARMUP = min(3, RUNS)


def _time(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(int(cpus)),
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    t_prepare = _time(lambda: prepared_for(spark, sf_dir))
    t_parts = _time(lambda: csv_parts_for(spark, sf_dir))
    print(f"prepare {t_prepare:.2f}s, csv parts {t_parts:.2f}s", file=sys.stderr)

    q = catalog.queries()
    labels = {"q1": "daily_revenue", "q2": "publisher_revenue", "q3": "avg_purchase", "q4": "event_counts", "q5": "minute_revenue"}
    plans = {}
    for name, label in labels.items():
        plans[f"{name}_rollup"] = q[f"r{name[1]}_{label}"]
        plans[f"{name}_store"] = q[f"{name}_{label}"]
        plans[f"{name}_csv"] = q[f"csv_{name}_{label}"]

    for _ in range(WARMUP):  # warm-up: JVM JIT and codegen caches, as set-up
        for fn in plans.values():
            fn(spark, sf_dir).collect()

    timings, execs = {}, {}
    for key, fn in plans.items():
        total, only_exec = [], []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            t1 = time.perf_counter()
            df.collect()
            t2 = time.perf_counter()
            total.append(t2 - t0)
            only_exec.append(t2 - t1)
        timings[key] = round(statistics.median(total), 4)
        execs[key] = round(statistics.median(only_exec), 4)
        print(f"{key:12s} {timings[key]:.3f}s (exec {execs[key]:.3f}s)", file=sys.stderr)

    # the five routed reports submitted together from five driver threads
    from concurrent.futures import ThreadPoolExecutor

    routed = [fn for key, fn in plans.items() if key.endswith("_rollup")]
    with ThreadPoolExecutor(max_workers=len(routed)) as pool:
        walls = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            list(pool.map(lambda fn: fn(spark, sf_dir).collect(), routed))
            walls.append(time.perf_counter() - t0)
    concurrent_wall = round(statistics.median(walls), 4)
    print(f"five routed reports, concurrent wall {concurrent_wall:.3f}s", file=sys.stderr)

    totals = {
        path: round(sum(v for k, v in timings.items() if k.endswith(path)), 4)
        for path in ("_rollup", "_store", "_csv")
    }
    exec_totals = {
        f"exec{path}_total": round(sum(v for k, v in execs.items() if k.endswith(path)), 4)
        for path in ("_rollup", "_store", "_csv")
    }
    out = {
        "metric": "five_reports_total_rollup",
        "value": totals["_rollup"],
        "unit": "sec",
        "queries": {
            **timings,
            "total_store": totals["_store"],
            "total_csv": totals["_csv"],
            **exec_totals,
            "concurrent_rollup_wall": concurrent_wall,
            "prepare": round(t_prepare, 3),
        },
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "events_rows": rows,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
