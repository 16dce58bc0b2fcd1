"""Incremental ingest: event parts are appended to the store as they arrive.

A Structured Streaming file source watches the part folder; every trigger
takes the new parts (at most ``max_files`` of them when set), types them
with the same rules as the batch path and appends them to the partitioned
Parquet store.  Columns are assigned by position with every header
verified, or by each part's own header with ``by_name=True``.  The
checkpoint records which parts were taken, so each part lands exactly once
even when a run is interrupted and restarted.  ``available_now=True`` works
through the backlog and stops (a batch-style catch-up); otherwise the query
keeps running with the given processing-time trigger.

A trigger of fewer parts than the cluster has cores would leave cores idle
while a few tasks write its many small files one after the other, so its rows
are dealt over all cores first, each task's rows of a ``(type, day)`` to one
task: the same files are written side by side.

The store is written through the file sink's log (``_spark_metadata``),
which is what makes appends exactly-once; read it with ``read_store`` and
let only the stream write to it.  Summary tables are not updated by this
stream: call :func:`adevents.plans.prepare.refresh_rollups` afterwards,
which recomputes only the changed days, or use
:func:`adevents.streaming.rollups.keep_up`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adevents.functions.typing import type_events
from adevents.schema import PART_GLOB, RAW_SCHEMA, STORE_PARTITIONS
from adevents.sources import manifest
from adevents.sources.files import CSV_DIALECT, arrow_csv_options, arrow_parse_options, check_line_breaks, open_filesystem


def stream_event_parts(
    spark: SparkSession, folder: str, max_files: int | None = None, pattern: str = PART_GLOB, multiline: bool = False
) -> DataFrame:
    """Streaming frame of raw text events from parts arriving in ``folder``.

    ``max_files`` caps the parts per trigger (1 = part by part); ``None``
    takes every new part in one trigger.
    """
    reader = spark.readStream.schema(RAW_SCHEMA).options(header=True, multiLine=multiline, enforceSchema=False, mode="FAILFAST", **CSV_DIALECT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(f"{folder.rstrip('/')}/{pattern}")


def _part_parser(multiline: bool):
    """Paths of parts -> raw rows, read in blocks, columns assigned by each part's header."""

    def parse_parts(batches):
        import pyarrow.csv as pacsv

        convert, parse = arrow_csv_options(), arrow_parse_options(multiline)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, inner = open_filesystem(path)
                if not filesystem.get_file_info(inner).size:
                    continue
                with filesystem.open_input_stream(inner) as part:
                    for rows in pacsv.open_csv(part, parse_options=parse, convert_options=convert):
                        if rows.num_rows:
                            yield check_line_breaks(rows, multiline)

    return parse_parts


def stream_event_parts_by_name(
    spark: SparkSession, folder: str, max_files: int | None = None, pattern: str = PART_GLOB, multiline: bool = False
) -> DataFrame:
    """Like :func:`stream_event_parts`, but columns are assigned by header name.

    The stream carries the new parts' paths only; each part is read in blocks
    with its own header by Arrow inside a stateless ``mapInArrow``, one task
    per part.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parts = reader.option("pathGlobFilter", pattern).load(folder)
    return parts.select("path").mapInArrow(_part_parser(multiline), RAW_SCHEMA)


def _dealt(events: DataFrame, max_files: int | None) -> DataFrame:
    """The rows of small triggers over all cores, by partition of the store and task that read them."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    if max_files is None or max_files >= cores:
        return events
    return events.withColumn("__split", F.spark_partition_id()).repartition(cores, *STORE_PARTITIONS, "__split").drop("__split")


def ingest_parts(
    spark: SparkSession,
    folder: str,
    store: str,
    checkpoint: str,
    max_files: int | None = None,
    available_now: bool = True,
    processing_time: str = "30 seconds",
    bad_price: str = "error",
    by_name: bool = False,
    multiline: bool = False,
) -> StreamingQuery:
    """Start appending typed parts from ``folder`` to the store at ``store``.

    ``by_name=True`` assigns columns by each part's header (parts in any
    column order); the default assigns by position and verifies headers.
    ``multiline=True`` keeps quoted line breaks, which fail the stream without.
    """
    manifest.set_version(spark, store, manifest.STREAMING)
    source = stream_event_parts_by_name if by_name else stream_event_parts
    typed = type_events(source(spark, folder, max_files, multiline=multiline), bad_price=bad_price)
    writer = (
        _dealt(typed, max_files).writeStream.format("parquet")
        .option("path", store)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy(*STORE_PARTITIONS)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def catch_up(
    spark: SparkSession,
    folder: str,
    store: str,
    checkpoint: str,
    max_files: int | None = None,
    bad_price: str = "error",
    by_name: bool = False,
    multiline: bool = False,
) -> StreamingQuery:
    """Append every part not yet ingested, then return the finished query."""
    q = ingest_parts(spark, folder, store, checkpoint, max_files, available_now=True, bad_price=bad_price, by_name=by_name, multiline=multiline)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    manifest.set_version(spark, store, manifest.new_version())
    return q
