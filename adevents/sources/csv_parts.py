"""Event parts as CSV files: ``events_part_*.csv`` with a header row.

Reading assigns columns **by header name**, not by position, so parts whose
headers list the columns in another order (or lack some) still line up.
It takes one cheap distributed job to read the first line of every part
(no data bytes), then one CSV scan per distinct header layout -- in
practice exactly one -- with ``enforceSchema=false`` so Spark itself
verifies every file's header against the layout it is read with.  The
scans are unioned by name.  Values stay text; only empty fields are NULL
(``NA`` and ``null`` stay text).

Writing (:func:`write_event_parts`) runs on the executors: every task
streams its rows into one ``events_part_<n>.csv`` in a shared folder.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adevents.schema import PART_GLOB, RAW_COLUMNS, RAW_SCHEMA
from adevents.sources.files import CSV_DIALECT, attempt_suffix, open_filesystem, publish

_CHUNK = 8 << 10
_MAX_HEADER = 1 << 20


def list_parts(spark: SparkSession, folder: str, pattern: str = PART_GLOB) -> DataFrame:
    """Part files of ``folder`` (one level); file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )


def _read_first_line(path: str) -> str:
    """The first line of a file, read in small chunks (a header is short)."""
    filesystem, inner = open_filesystem(path)
    head = b""
    with filesystem.open_input_stream(inner) as f:
        while True:
            if len(head) > _MAX_HEADER:
                raise ValueError(f"no line end in the first {_MAX_HEADER} bytes of {path}; is it a CSV part?")
            chunk = f.read(_CHUNK)
            if not chunk:
                break
            head += chunk
            if b"\n" in chunk or b"\r" in chunk:
                break
    text = head.decode("utf-8-sig", errors="replace")
    return text.splitlines()[0] if text.strip() else ""


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        headers = []
        for path in pdf["path"]:
            line = _read_first_line(path)
            names = next(csv.reader(io.StringIO(line)), []) if line else []
            headers.append("\x1f".join(n.strip() for n in names) if names else None)
        yield pd.DataFrame({"path": pdf["path"], "header": headers})


def part_headers(spark: SparkSession, folder: str, pattern: str = PART_GLOB) -> DataFrame:
    """``(path, header)`` per part; header NULL for an empty file."""
    files = list_parts(spark, folder, pattern).select("path")
    return files.mapInPandas(_first_lines, "path string, header string")


def _scan(spark: SparkSession, paths, names: list[str], options: dict) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    reader = spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST", **CSV_DIALECT, **options)
    df = reader.csv(paths)
    return df.select(*[F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])


def read_event_parts(spark: SparkSession, folder: str, pattern: str = PART_GLOB, multiline: bool = False) -> DataFrame:
    """All parts of ``folder`` as the nine raw text columns, by header name.

    Raises ``FileNotFoundError`` when no part exists; header-only and empty
    parts contribute no rows.  A quoted field with a line break fails the read,
    since a part may be split between any two lines; with ``multiline=True``
    parts are read whole, one task each, and such fields are kept.
    """
    options = {"multiLine": True} if multiline else {}
    headers = part_headers(spark, folder, pattern).where(F.col("header").isNotNull())
    # distinct header layouts only (tiny); paths are fetched only if they differ
    layouts = [r.header for r in headers.select("header").distinct().collect()]
    if not layouts:
        if list_parts(spark, folder, pattern).isEmpty():
            raise FileNotFoundError(f"no {pattern} in {folder}")
        return spark.createDataFrame([], RAW_SCHEMA)
    unknown_only = [h for h in layouts if not set(h.split("\x1f")) & set(RAW_COLUMNS)]
    if unknown_only:
        raise ValueError(f"part headers without any event column: {unknown_only[:3]}")
    if len(layouts) == 1:
        return _scan(spark, folder, layouts[0].split("\x1f"), {"pathGlobFilter": pattern, **options})
    # Layouts differ: one scan per layout over its own files.  The file list
    # is metadata the driver's file index holds anyway; it is collected as
    # plain rows (no per-layout list is built inside a task).
    by_layout: dict[str, list[str]] = {}
    for r in headers.select("header", "path").collect():
        by_layout.setdefault(r.header, []).append(r.path)
    scans = [_scan(spark, sorted(paths), header.split("\x1f"), options) for header, paths in sorted(by_layout.items())]
    return reduce(lambda a, b: a.unionByName(b), scans)


def _part_writer(folder: str, mixed_headers: bool):
    def write(batches):
        import pyarrow as pa
        import pyarrow.csv as pacsv

        filesystem, root = open_filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        out = writer = None
        order = list(RAW_COLUMNS)
        name, tmp, rows = None, None, 0
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    pid = batch.column("__pid")[0].as_py()
                    name = f"events_part_{pid:05d}.csv"
                    if mixed_headers and pid % 2 == 1:
                        order = order[::-1]
                    tmp = f"{root}/{name}{attempt_suffix()}"
                    out = filesystem.open_output_stream(tmp)
                    schema = pa.schema([(c, pa.string()) for c in order])
                    writer = pacsv.CSVWriter(out, schema, write_options=pacsv.WriteOptions(quoting_style="needed"))
                writer.write_batch(pa.RecordBatch.from_arrays([batch.column(c) for c in order], names=order))
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
            if out is not None:
                out.close()
        if name is not None:
            publish(filesystem, tmp, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [rows]}, schema=pa.schema([("file", pa.string()), ("rows", pa.int64())]))

    return write


def write_event_parts(raw: DataFrame, folder: str, parts: int | None = None, mixed_headers: bool = False) -> DataFrame:
    """Write raw text events as ``events_part_<n>.csv`` files (one per task).

    ``mixed_headers`` writes every odd-numbered part with the columns in
    reverse order (and a header saying so), as parts from different
    producers may arrive.

    Tasks stream Arrow record batches straight into the CSV writer.
    Returns the ``(file, rows)`` summary, one row per written part.
    """
    filesystem, root = open_filesystem(folder)
    filesystem.create_dir(root, recursive=True)
    df = raw.select(*RAW_COLUMNS)
    if parts is not None:
        df = df.repartition(parts)
    written = df.withColumn("__pid", F.spark_partition_id()).mapInArrow(
        _part_writer(folder, mixed_headers), "file string, rows long"
    )
    summary = written.collect()
    return raw.sparkSession.createDataFrame(summary, "file string, rows long")
