"""A store and its summary tables kept up together by a stream of event parts.

Every micro-batch writes its events to a folder of its own (``batch=<n>``),
aggregates just these events to a further folder of every summary table, and
commits both by one entry of the store's manifest: the last batch that counts,
and the tables' folders.  Until that commit nobody reads any of it, so answers
are those of the batches before, and an entry's tables always fit its events.

A batch of ``SMALL_ROWS`` events at most would spend its time on the many tiny files
of its types and days.  It is typed once, by all cores, and kept while a few sorted
files of its events, and one of each table's rows, are written side by side.

A table's folders hold partial rows that readers merge
(:func:`adevents.operators.rollups.merge_rollup`).  Folders of about one size are
merged into a new one as soon as there are ``MERGE_FOLDERS`` of them, so a table has
some folders per power of eight of its rows, a row is merged again once per such
power, and a batch costs what its own events cost, however many came before.

A batch that is delivered again (after a failure) has the same number: if its
entry was committed, nothing is done; if not, its folder is overwritten and its
events are aggregated again into folders of their own, so nothing is counted
twice.  Late events of old days are partial rows like any others.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adevents.functions.typing import type_events
from adevents.operators.rollups import ROLLUPS, Rollup, build_rollup, folder_name, merge_rollup, read_snapshot, write_counted
from adevents.plans.prepare import PreparedStore, build_folders
from adevents.schema import EVENT_COLUMNS, RAW_COLUMNS, STORE_PARTITIONS
from adevents.session import prepare_session
from adevents.sources import manifest
from adevents.sources.store import CLUSTER_COLUMNS, batch_folder, read_batches, read_store
from adevents.streaming.ingest import stream_event_parts, stream_event_parts_by_name

#: So many folders of about one size (a power of eight of rows) become one.
MERGE_FOLDERS = 8
#: A batch of so many events at most, and folders of a table with so many rows, aren't split by types and days.
SMALL_ROWS = 8**6
#: Events of a small batch per file, about.
FILE_ROWS = 8**5
#: So many tasks work on the rows of a part.
PART_TASKS = 8


def _size(folder: manifest.Folder) -> int:
    return (max(folder.rows, 1).bit_length() - 1) // 3


def _merged(spark: SparkSession, prepared: PreparedStore, rollup: Rollup, folders: list[manifest.Folder]) -> list[manifest.Folder]:
    """The table's folders, after merging those of sizes that have too many; merged ones stay for earlier entries."""
    while True:
        sizes = [_size(f) for f in folders]
        full = [s for s in sorted(set(sizes)) if sizes.count(s) >= MERGE_FOLDERS]
        if not full:
            return folders
        old = [f for f, s in zip(folders, sizes) if s == full[0]]
        small = not rollup.bucketed and sum(f.rows for f in old) <= SMALL_ROWS
        path = f"{prepared.rollup_path(rollup.name)}/{folder_name(small)}"
        partial = read_snapshot(spark, rollup, [(f.path, f.without) for f in old])
        rows = write_counted(merge_rollup(partial.coalesce(1) if small else partial, rollup), rollup, path)
        folders = [f for f in folders if f not in old] + [manifest.Folder(path, rows)]


def _write_batch(prepared: PreparedStore, events: DataFrame, batch: int, rollups) -> dict[str, list[manifest.Folder]]:
    """Writes a batch's events and their partial rows of the summary tables; gives the tables' new folders."""
    spark = events.sparkSession
    events = events.select(*EVENT_COLUMNS).persist()
    try:
        rows = events.count()
        small = rows <= SMALL_ROWS
        folder = batch_folder(prepared.events_path, batch, small)
        manifest.delete(spark, batch_folder(prepared.events_path, batch, not small))  # of a delivery that broke off
        if not small:
            laid_out = events.hint("rebalance", *STORE_PARTITIONS).sortWithinPartitions(*STORE_PARTITIONS, *CLUSTER_COLUMNS)
            laid_out.write.mode("overwrite").partitionBy(*STORE_PARTITIONS).option("compression", "zstd").parquet(folder)
            return build_folders(spark, prepared, read_store(spark, folder), rollups, None, {})

        def build(rollup: Rollup) -> tuple[str, list[manifest.Folder]]:
            small = not rollup.bucketed  # a row of a bucketed table may be large
            path = f"{prepared.rollup_path(rollup.name)}/{folder_name(small)}"
            rows = write_counted(build_rollup(events.coalesce(1) if small else events, rollup), rollup, path)
            return rollup.name, [manifest.Folder(path, rows)]

        with ThreadPoolExecutor(max_workers=4) as pool:
            built = pool.map(build, rollups)
            laid_out = events.coalesce(rows // FILE_ROWS + 1).sortWithinPartitions(*STORE_PARTITIONS, *CLUSTER_COLUMNS)
            laid_out.write.mode("overwrite").option("compression", "zstd").parquet(folder)
            return dict(built)
    finally:
        events.unpersist()


def append_batch(prepared: PreparedStore, events: DataFrame, batch: int, rollups=ROLLUPS) -> bool:
    """Adds a batch of typed events to the store and its summary tables; gives False if it was there already."""
    spark = events.sparkSession
    base = manifest.current(spark, prepared.events_path)
    if base is not None and base.batch is None:
        raise ValueError(f"the store at {prepared.events_path} isn't kept up batch by batch")
    if base is not None and batch <= base.batch:
        return False
    listed = dict(base.rollups) if base is not None else {}
    known = [r for r in rollups if base is None or r.name in listed]
    folders = _write_batch(prepared, events, batch, known)
    with ThreadPoolExecutor(max_workers=4) as pool:
        merged = pool.map(lambda r: _merged(spark, prepared, r, [*listed.get(r.name, ()), *folders[r.name]]), known)
        tables = {r.name: f for r, f in zip(known, merged)}
    added = [r for r in rollups if r not in known]
    if added:  # tables that the store didn't have need all its events once
        tables |= build_folders(spark, prepared, read_batches(spark, prepared.events_path, batch).select(*EVENT_COLUMNS), added, None, {})
    entry = replace(base or manifest.Entry(), version=manifest.new_version(), batch=batch, rollups={n: tuple(f) for n, f in tables.items()})
    manifest.commit(spark, prepared.events_path, entry)  # fails if another writer was faster
    return True


def _dealt(raw: DataFrame, max_files: int | None) -> DataFrame:
    """The rows of small triggers over more cores: as text, before the work on them."""
    cores = raw.sparkSession.sparkContext.defaultParallelism
    return raw if max_files is None or max_files >= cores else raw.repartition(min(cores, max_files * PART_TASKS), *RAW_COLUMNS)


def keep_up(
    spark: SparkSession,
    folder: str,
    root: str,
    max_files: int | None = None,
    available_now: bool = True,
    processing_time: str = "30 seconds",
    bad_price: str = "error",
    by_name: bool = True,
    rollups=ROLLUPS,
) -> StreamingQuery:
    """Start feeding the store and summary tables below ``root`` with the parts that arrive in ``folder``."""
    prepare_session(spark)
    prepared = PreparedStore(root)
    source = stream_event_parts_by_name if by_name else stream_event_parts
    typed = type_events(_dealt(source(spark, folder, max_files), max_files), bad_price=bad_price)
    writer = typed.writeStream.foreachBatch(lambda events, batch: append_batch(prepared, events, batch, rollups) and None)
    writer = writer.option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
