"""Report results as CSV with a header row, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adevents.sources.files import CSV_DIALECT


def write_result_csv(result: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a report result as CSV with a header (every part has one).

    By default every task writes its own part, so a large result never
    funnels through one task; a sorted result is globally ordered across
    the parts in part-number order.  ``single_file=True`` coalesces a
    result known to be small into one ``part-*.csv`` (order kept).
    """
    out = result.coalesce(1) if single_file else result
    out.write.mode("overwrite").options(header=True, **CSV_DIALECT).csv(path)
    return path
