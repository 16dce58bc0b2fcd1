"""Prepare: typed events -> event store + summary tables.

``prepare(events, root)`` writes the partitioned event store, then each rollup
aggregated from the *written* store (so each rollup scan reads only its
partitions and columns, never the raw input again) into a new folder, and last
lists these folders in the store's manifest (:mod:`adevents.sources.manifest`).
A folder that isn't listed for the store's current version is never read, and a
listed one is never written again.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.operators.rollups import MERGEABLE, ROLLUPS, Rollup, build_rollup, merge_rollup, read_snapshot, write_counted
from adevents.schema import EVENT_COLUMNS
from adevents.session import _join, prepare_session, scratch_path
from adevents.sources import manifest
from adevents.sources.store import read_batches, read_store, write_store


#: A summary table of more folders than this is built whole again by its next refresh.
MAX_FOLDERS = 8


@dataclass
class PreparedStore:
    """Paths of a prepared store, and its relations once they are opened.

    Each relation (its schema and file listing, never its rows) is opened
    once per session and reused by every report -- the way a view is
    defined once and queried many times.  :meth:`sync` compares with the
    manifest, drops what was opened before a change and takes over the
    summary tables that are listed for the current version; ``answer`` calls
    it for every report.  A report that was planned before a change goes on
    reading the folders of its own entry, which nobody overwrites.
    """

    root: str
    rollup_paths: dict[str, list[str]] = field(default_factory=dict)
    rollup_rows: dict[str, int] = field(default_factory=dict)
    entry: manifest.Entry | None = field(default=None, repr=False)
    _frames: dict = field(default_factory=dict, repr=False)

    @property
    def events_path(self) -> str:
        return _join(self.root, "events")

    def _open(self, spark: SparkSession, name: str, make) -> DataFrame:
        key = (spark.sparkContext.applicationId, name)
        if key not in self._frames:
            self._frames[key] = make()
        return self._frames[key]

    def events(self, spark: SparkSession) -> DataFrame:
        last = self.entry.batch if self.entry else None
        if last is None:
            return self._open(spark, "events", lambda: read_store(spark, self.events_path))
        return self._open(spark, "events", lambda: read_batches(spark, self.events_path, last).select(*EVENT_COLUMNS))

    def rollup(self, spark: SparkSession, rollup: Rollup) -> DataFrame:
        folders = self.entry.rollups[rollup.name]

        def read() -> DataFrame:
            table = read_snapshot(spark, rollup, [(f.path, f.without) for f in folders])
            # folders of a store that is kept up batch by batch have partial rows
            return table if self.entry.batch is None or len(folders) == 1 else merge_rollup(table, rollup)

        return self._open(spark, rollup.name, read)

    def rollup_path(self, name: str) -> str:
        return _join(self.root, f"agg_{name}")

    def sync(self, spark: SparkSession) -> str:
        """Follow the manifest; gives the store's version.

        Raises ``FileNotFoundError`` when there is no store or a write of it
        didn't finish.
        """
        entry = manifest.current(spark, self.events_path)
        if entry is None or not entry.complete:
            raise FileNotFoundError(f"no complete event store at {self.events_path}; prepare it first")
        if self.entry is None or entry.seq != self.entry.seq or entry.version == manifest.STREAMING:
            self._frames.clear()
        self.entry = entry
        self.rollup_rows = {name: sum(f.rows for f in folders) for name, folders in entry.rollups.items()}
        self.rollup_paths = {name: [f.path for f in folders] for name, folders in entry.rollups.items()}
        return entry.version


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw text events from a folder of CSV parts or from zip archive(s).

    A path ending in ``.zip`` (or a glob of them) is read with the zip
    source; anything else is a folder of ``events_part_*.csv``.
    """
    from adevents.sources.csv_parts import read_event_parts
    from adevents.sources.zip_parts import read_event_zip

    if path.rstrip("/").lower().endswith(".zip"):
        return read_event_zip(spark, path)
    return read_event_parts(spark, path)


def prepare_from_path(spark: SparkSession, path: str, root: str, bad_price: str = "error") -> PreparedStore:
    """Read raw parts (folder or zip), type them and prepare the store."""
    from adevents.functions.typing import type_events

    prepare_session(spark)
    return prepare(type_events(read_raw_events(spark, path), bad_price=bad_price), root)


def prepare(events: DataFrame, root: str, rollups=ROLLUPS, parallel: int = 3) -> PreparedStore:
    """Write the store, then build every rollup from the written files.

    The rollups are independent pruned reads of the store, so up to
    ``parallel`` of them are submitted at once from driver threads; their
    jobs overlap on the cluster (results do not depend on it).
    """
    spark = events.sparkSession
    prepared = PreparedStore(root)
    write_store(events, prepared.events_path)
    return refresh_rollups(spark, prepared, rollups=rollups, parallel=parallel)


def open_prepared(spark: SparkSession, root: str, rollups=ROLLUPS) -> PreparedStore:
    """Reopen a store prepared earlier (by another application).

    Raises ``FileNotFoundError`` when ``root`` holds no complete event store;
    summary tables that aren't listed for its version are not offered to
    :func:`answer`.
    """
    prepare_session(spark)
    prepared = PreparedStore(root)
    prepared.sync(spark)
    return prepared


def refresh_rollups(
    spark: SparkSession, prepared: PreparedStore, days: Iterable | None = None, rollups=ROLLUPS, parallel: int = 3
) -> PreparedStore:
    """Build the summary tables of the store's current version.

    Every table is written to a folder of its own and listed by one commit at
    the end.  A refresh that breaks off leaves folders that nobody reads; one
    that meets a change of the store raises :class:`manifest.Conflict` and
    lists nothing.  In between, reports read the tables listed before.

    With ``days`` given (``None`` among them for rows without a day), a table
    partitioned by ``day`` that was listed before the store's last change gets
    a folder with these days, re-read from the store, in place of what its
    other folders hold of them.  The caller states that no other day changed.
    Tables that aren't partitioned by ``day``, weren't listed, or have too many
    folders are built whole.

    The tables are independent pruned reads, so up to ``parallel`` of them are
    submitted at once from driver threads.
    """
    version = prepared.sync(spark)
    base = prepared.entry
    listed = _listed_before(spark, prepared, rollups) if days is not None else {}
    folders = build_folders(spark, prepared, prepared.events(spark), rollups, days, listed, parallel)
    if version != manifest.STREAMING:  # where a stream may go on, nothing stays true
        manifest.add_rollups(spark, prepared.events_path, version, folders, base)
    prepared.sync(spark)
    return prepared


def _listed_before(spark: SparkSession, prepared: PreparedStore, rollups) -> dict[str, tuple[manifest.Folder, ...]]:
    """The last listed folders of each table, whatever the store's version was."""
    found: dict[str, tuple[manifest.Folder, ...]] = {}
    wanted = {r.name for r in rollups}
    for seq in reversed(manifest.numbers(spark, prepared.events_path)):
        for name, folders in manifest.read(spark, prepared.events_path, seq).rollups.items():
            found.setdefault(name, folders)
        if wanted <= set(found):
            break
    return {n: f for n, f in found.items() if n in wanted}


def build_folders(
    spark: SparkSession, prepared: PreparedStore, store: DataFrame, rollups, days, listed, parallel: int = 3
) -> dict[str, list[manifest.Folder]]:
    """Writes new folders of the summary tables; gives every table's folders."""
    asked = None if days is None else sorted({None if d is None else str(d) for d in days}, key=str)

    def build(r: Rollup) -> tuple[str, list[manifest.Folder]]:
        path = f"{prepared.rollup_path(r.name)}/{manifest.new_version()}"
        kept = listed.get(r.name, ())
        whole = asked is None or "day" not in r.partition_by or not kept or len(kept) >= MAX_FOLDERS
        rows = write_counted(build_rollup(store if whole else store.where(_on_days(asked)), r), r, path)
        new = manifest.Folder(path, rows)
        if whole:
            return r.name, [new]
        without = [tuple(sorted({*f.without, *asked}, key=str)) for f in kept]
        return r.name, [manifest.Folder(f.path, f.rows, w) for f, w in zip(kept, without)] + [new]

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(rollups)))) as pool:
        return dict(pool.map(build, rollups))


def drop_old_rollups(spark: SparkSession, prepared: PreparedStore, rollups=ROLLUPS, keep: int = 2) -> list[str]:
    """Deletes folders of summary tables that none of the last ``keep`` entries lists.

    Call it when no refresh is under way and no report reads older entries.
    """
    folders = [f for r in rollups for f in manifest.subfolders(spark, prepared.rollup_path(r.name))]
    return manifest.drop_unlisted(spark, prepared.events_path, folders, keep)


def _on_days(days):
    known = [F.lit(str(d)).cast("date") for d in days if d is not None]
    cond = F.col("day").isin(*known) if known else F.lit(False)
    return cond | F.col("day").isNull() if None in list(days) else cond


_CACHE: dict[tuple[str, str], PreparedStore] = {}
_LOCK = threading.RLock()


def mergeable_for(spark: SparkSession, sf_dir: str) -> PreparedStore:
    """:func:`prepared_for` with the tables of mergeable measures."""
    prepared = prepared_for(spark, sf_dir)
    with _LOCK:
        if not {r.name for r in MERGEABLE} <= set(prepared.rollup_paths):
            refresh_rollups(spark, prepared, rollups=MERGEABLE)
    return prepared


def streamed_rollups_for(spark: SparkSession, sf_dir: str) -> PreparedStore:
    """Store and summary tables kept up by a stream of the CSV parts, two per trigger; the last batch comes twice."""
    from adevents.functions.typing import type_events
    from adevents.streaming.rollups import append_batch, keep_up

    def build() -> str:
        folder = csv_parts_for(spark, sf_dir)
        root = scratch_path(spark, "kept")
        query = keep_up(spark, folder, root, max_files=2)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        prepared = PreparedStore(root)
        prepared.sync(spark)
        append_batch(prepared, type_events(read_raw_events(spark, folder)), prepared.entry.batch)
        return root

    prepared = PreparedStore(_once(spark, sf_dir, "kept", build))
    prepared.sync(spark)
    return prepared


def prepared_for(spark: SparkSession, sf_dir: str) -> PreparedStore:
    """The store prepared from ``sf_dir``'s events, built once per application."""
    from adevents.plans.adapter import load_ad_events

    prepare_session(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CACHE:
            root = scratch_path(spark, "store")
            _CACHE[key] = prepare(load_ad_events(spark, sf_dir), root)
        return _CACHE[key]


def clustered_for(spark: SparkSession, sf_dir: str) -> str:
    """The events of the driver's table in a store whose rows follow a space-filling curve."""
    from adevents.sources.layout import Curve

    def build() -> str:
        path = _join(scratch_path(spark, "clustered"), "events")
        return write_store(prepared_for(spark, sf_dir).events(spark), path, curve=Curve())

    return _once(spark, sf_dir, "clustered", build)


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    with _LOCK:
        if key not in _FILES:
            _FILES[key] = build()
        return _FILES[key]


_FILES: dict[tuple[str, str, str], str] = {}

# Events per rendered part; there are a few parts at least, so multi-part reading is real.
PART_EVENTS = 50_000
MIN_PARTS = 4


def _n_parts(events: DataFrame) -> int:
    return max(MIN_PARTS, -(-events.count() // PART_EVENTS))


def csv_parts_for(spark: SparkSession, sf_dir: str, mixed_headers: bool = True) -> str:
    """Folder of ``events_part_*.csv`` rendered from ``sf_dir``'s events.

    With ``mixed_headers`` every odd part lists its columns in reverse order.
    """
    from adevents.plans.adapter import load_ad_events, raw_events
    from adevents.sources.csv_parts import write_event_parts

    def build() -> str:
        prepare_session(spark)
        folder = scratch_path(spark, "csv-parts")
        events = load_ad_events(spark, sf_dir)
        write_event_parts(raw_events(events), folder, parts=_n_parts(events), mixed_headers=mixed_headers)
        return folder

    return _once(spark, sf_dir, f"csv-{mixed_headers}", build)


# Every how many events a line of the damaged parts lacks a field, has one more, or a malformed price.
DAMAGE = {"short": 97, "price": 101, "long": 103}


def damaged_parts_for(spark: SparkSession, sf_dir: str) -> str:
    """Folder of parts (``part-*.txt``) with a share of bad lines, by event id."""
    from adevents.plans.adapter import load_ad_events, raw_events
    from adevents.schema import RAW_COLUMNS

    def build() -> str:
        folder = scratch_path(spark, "damaged")
        events = load_ad_events(spark, sf_dir)
        nth = F.substring("auction_id", 2, 20).cast("long")
        bad = {k: nth % every == 0 for k, every in DAMAGE.items()}
        raw = raw_events(events).withColumn("total_price", F.when(bad["price"], "12.5x").otherwise(F.col("total_price")))
        fields = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]
        line = F.when(bad["short"], F.concat_ws(",", *fields[:-1])).when(bad["long"], F.concat_ws(",", *fields, F.lit("more")))
        lines = raw.select(F.pmod(nth, F.lit(_n_parts(events))).alias("part"), line.otherwise(F.concat_ws(",", *fields)).alias("line"))
        # a part has PART_EVENTS lines
        text = lines.groupBy("part").agg(F.array_join(F.collect_list("line"), "\n").alias("body"))
        text.select(F.concat_ws("\n", F.lit(",".join(RAW_COLUMNS)), "body").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
        return folder

    return _once(spark, sf_dir, "damaged", build)


def zip_parts_for(spark: SparkSession, sf_dir: str) -> str:
    """Folder of zip archives (one part member each, plus a __MACOSX copy)."""
    from adevents.plans.adapter import load_ad_events, raw_events
    from adevents.sources.zip_parts import write_event_zips

    def build() -> str:
        prepare_session(spark)
        folder = scratch_path(spark, "zip-parts")
        events = load_ad_events(spark, sf_dir)
        write_event_zips(raw_events(events).repartition(_n_parts(events)), folder)
        return folder

    return _once(spark, sf_dir, "zip", build)


def ingested_store_for(spark: SparkSession, sf_dir: str, by_name: bool = False) -> str:
    """Store built by streaming the CSV parts in one part per trigger.

    The positional stream is fed parts in the canonical column order (it
    verifies each header); the by-name stream gets parts in mixed orders.
    """
    from adevents.streaming.ingest import catch_up

    def build() -> str:
        folder = csv_parts_for(spark, sf_dir, mixed_headers=by_name)
        root = scratch_path(spark, "stream")
        store = _join(root, "events")
        catch_up(spark, folder, store, _join(root, "checkpoint"), max_files=1, by_name=by_name)
        return store

    return _once(spark, sf_dir, f"stream-{by_name}", build)
