"""Summary tables as snapshots: commits, broken and raced refreshes, streams."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adevents.operators.rollups import COUNTS, DAILY_REVENUE, ROLLUPS, build_rollup
from adevents.plans import prepare as P
from adevents.plans.answer import answer
from adevents.sources import manifest
from adevents.sources.store import write_store

from .test_store import EVENT, _events

COUNT = dict(select=["COUNT(*)"])
REVENUE = dict(select=["SUM(bid_price)"], where=[{"col": "type", "op": "eq", "val": "impression"}])


def _answers(spark, store):
    out = []
    for clauses in (COUNT, REVENUE):
        result, source = answer(spark, store, **clauses)
        out.append((result.collect()[0][0], source))
    return out


def test_only_one_of_two_commits_wins(spark, scratch):
    first = manifest.commit(spark, scratch, manifest.Entry(version="a"))
    assert first.seq == 1 and manifest.current(spark, scratch) == first
    manifest.commit(spark, scratch, manifest.Entry(seq=1, version="b"))
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, scratch, manifest.Entry(seq=1, version="c"))
    assert manifest.current(spark, scratch).version == "b"
    assert manifest.current(spark, scratch + "/nothing") is None
    tries = []

    def change(last):
        if not tries:  # somebody else is faster once
            manifest.commit(spark, scratch, manifest.Entry(seq=last.seq, version="other"))
        tries.append(last.version)
        return manifest.Entry(version="mine after " + last.version)

    assert manifest.update(spark, scratch, change).version == "mine after other" and tries == ["b", "other"]


def test_a_refresh_that_breaks_off_changes_no_answer(spark, scratch, monkeypatch):
    store = P.prepare(_events(spark, [EVENT] * 4), scratch)
    want = _answers(spark, store)
    assert want == [(4, "counts"), (2.0, "daily_revenue")]
    write = P.write_counted

    def breaks_off(table, rollup, path):
        if rollup is COUNTS:
            write(table.limit(0), rollup, path)
            raise OSError("no space left")
        return write(table, rollup, path)

    monkeypatch.setattr(P, "write_counted", breaks_off)
    for days in (None, ["2024-06-01"]):
        with pytest.raises(OSError):
            P.refresh_rollups(spark, store, days)
        assert _answers(spark, store) == want
        assert _answers(spark, P.open_prepared(spark, scratch)) == want


@pytest.mark.parametrize("days", [None, ["2024-06-01"]])
def test_a_refresh_that_meets_an_append_lists_nothing(spark, scratch, monkeypatch, days):
    store = P.prepare(_events(spark, [EVENT] * 4), scratch)
    write, appended = P.write_counted, []

    def appends(table, rollup, path):
        rows = write(table, rollup, path)
        if not appended:
            appended.append(write_store(_events(spark, [EVENT] * 4), store.events_path, replace="none"))
        return rows

    monkeypatch.setattr(P, "write_counted", appends)
    with pytest.raises(manifest.Conflict):
        P.refresh_rollups(spark, store, days, parallel=1)
    assert _answers(spark, store) == [(8, "events"), (4.0, "events")]
    P.refresh_rollups(spark, store, days)
    assert _answers(spark, store) == [(8, "counts"), (4.0, "daily_revenue")]


def test_two_refreshes_at_once_list_one(spark, scratch):
    store = P.prepare(_events(spark, [EVENT] * 2), scratch)
    slow = P.PreparedStore(scratch)
    version = slow.sync(spark)
    folders = P.build_folders(spark, slow, slow.events(spark), ROLLUPS, None, {})
    P.refresh_rollups(spark, store)
    with pytest.raises(manifest.Conflict):
        manifest.add_rollups(spark, slow.events_path, version, folders, slow.entry)
    assert _answers(spark, store) == [(2, "counts"), (1.0, "daily_revenue")]


def test_a_planned_report_reads_its_own_snapshot(spark, scratch):
    store = P.prepare(_events(spark, [EVENT] * 2), scratch)
    before, _ = answer(spark, store, **COUNT)
    write_store(_events(spark, [EVENT] * 3), store.events_path, replace="none")
    P.refresh_rollups(spark, store, ["2024-06-01"])
    assert before.collect()[0][0] == 2 and _answers(spark, store)[0] == (5, "counts")
    # days replaced many times, null days among them, end in one folder again
    for i in range(P.MAX_FOLDERS + 1):
        write_store(_events(spark, [(None, "impression", 1.0)]), store.events_path, replace="none")
        P.refresh_rollups(spark, store, [None])
        assert len(store.rollup_paths["counts"]) <= P.MAX_FOLDERS
        assert _answers(spark, store) == [(6 + i, "counts"), (3.5 + i, "daily_revenue")]
    gone = P.drop_old_rollups(spark, store)
    assert gone and _answers(spark, P.open_prepared(spark, scratch))[0] == (5 + P.MAX_FOLDERS + 1, "counts")


def test_refreshed_tables_read_the_changed_days_only(spark, events, scratch):
    store = P.prepare(events, scratch, rollups=(DAILY_REVENUE,))
    folders = P.build_folders(spark, store, store.events(spark), (DAILY_REVENUE,), ["2024-01-03", None], store.entry.rollups)
    old, new = folders["daily_revenue"]
    assert old.without == ("2024-01-03", None) and new.rows <= old.rows
    days = {r.day for r in spark.read.parquet(new.path).select("day").distinct().collect()}
    assert days <= {dt.date(2024, 1, 3), None}
    table = P.read_snapshot(spark, DAILY_REVENUE, [(f.path, f.without) for f in (old, new)])
    want = build_rollup(events, DAILY_REVENUE)
    assert sorted(map(repr, table.select("day", "publisher_id", "country").collect())) == sorted(map(repr, want.select("day", "publisher_id", "country").collect()))
    assert "PartitionFilters: [" in table._jdf.queryExecution().executedPlan().toString()


def test_a_broken_append_can_be_mended_by_a_whole_write(spark, scratch):
    store = P.prepare(_events(spark, [EVENT]), scratch)
    bad = _events(spark, [EVENT]).withColumn("auction_id", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        write_store(bad, store.events_path, replace="none")
    with pytest.raises(FileNotFoundError):
        store.sync(spark)
    write_store(_events(spark, [EVENT]), store.events_path, replace="none")  # another append doesn't tell what broke off
    with pytest.raises(FileNotFoundError):
        store.sync(spark)
    write_store(_events(spark, [EVENT] * 3), store.events_path)
    assert _answers(spark, store) == [(3, "events"), (1.5, "events")]


# ---- streams --------------------------------------------------------------------


def _part(spark, folder, n, rows):
    from adevents.schema import RAW_COLUMNS

    lines = [",".join(RAW_COLUMNS)] + [f"{ts},{kind},a{i},1,2,{price},3,,US" for i, (ts, kind, price) in enumerate(rows)]
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/events_part_{n:05d}.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_streamed_tables_follow_every_batch(spark, scratch, monkeypatch):
    from adevents.streaming import rollups as S

    day = lambda d: int(dt.datetime(2024, 6, d, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    folder, root = scratch + "/parts", scratch + "/root"
    _part(spark, folder, 0, [(day(1), "impression", 1.0), (day(2), "impression", 2.0), ("", "impression", 7.0)])
    S.keep_up(spark, folder, root, max_files=1).awaitTermination()
    store = P.PreparedStore(root)
    assert _answers(spark, store) == [(3, "counts"), (10.0, "daily_revenue")]
    # a late event of an old day, in a batch whose commit breaks off the first time
    _part(spark, folder, 1, [(day(1), "impression", 4.0), (day(3), "click", 1.0)])
    commit, calls = manifest.commit, []

    def fails_once(spark, path, entry):
        calls.append(entry.batch)
        if len(calls) == 1:
            raise OSError("lost")
        return commit(spark, path, entry)

    monkeypatch.setattr(manifest, "commit", fails_once)
    with pytest.raises(Exception, match="lost"):
        S.keep_up(spark, folder, root, max_files=1).awaitTermination()
    assert _answers(spark, store) == [(3, "counts"), (10.0, "daily_revenue")]  # written, but not committed
    S.keep_up(spark, folder, root, max_files=1).awaitTermination()
    assert calls == [1, 1] and _answers(spark, store) == [(5, "counts"), (14.0, "daily_revenue")]
    # the batch comes again
    again = store.events(spark).where("type = 'click'")
    assert S.append_batch(store, again, 1) is False and _answers(spark, store) == [(5, "counts"), (14.0, "daily_revenue")]
    for r in ROLLUPS:
        got = sorted(map(repr, store.rollup(spark, r).collect()))
        assert got == sorted(map(repr, build_rollup(store.events(spark), r).select(*r.dims, *r.stored).collect()))
    S.keep_up(spark, folder, root).awaitTermination()  # nothing new
    assert _answers(spark, store)[0] == (5, "counts")


def test_a_batch_store_is_no_stream_store(spark, scratch):
    from adevents.streaming.rollups import append_batch

    store = P.prepare(_events(spark, [EVENT]), scratch)
    with pytest.raises(ValueError, match="batch by batch"):
        append_batch(store, _events(spark, [EVENT]), 0)


def test_a_batch_reads_no_earlier_events(spark, scratch, monkeypatch):
    from adevents.operators.rollups import MERGEABLE
    from adevents.streaming import rollups as S

    tables = ROLLUPS + MERGEABLE
    store = P.PreparedStore(scratch)
    price = F.when(F.col("auction_id") != "x", F.lit(0.25)).cast("double")
    for batch in range(8):
        if batch == 1:  # events of earlier batches aren't read, whatever days a batch has

            def no_read(*_):
                raise AssertionError("earlier batches were read")

            monkeypatch.setattr(S, "read_batches", no_read)
            monkeypatch.setattr(S, "MERGE_FOLDERS", 3, raising=False)
        events = _events(spark, [EVENT] * (batch + 1)).withColumns(
            {"bid_price": price * (1 + batch * batch), "total_price": F.when(F.lit(batch == 4), price * 3), "user_id": F.lit(batch % 3).cast("long")}
        )
        assert S.append_batch(store, events, batch, rollups=tables)
    assert S.append_batch(store, events, 7, rollups=tables) is False
    store.sync(spark)
    six = lambda row: [round(x, 6) if isinstance(x, float) else x for x in row]
    for r in tables:
        assert 1 < len(store.rollup_paths[r.name]) < 8  # partial rows, some merged
        want = build_rollup(store.events(spark), r).select(*r.dims, *r.stored)
        got = store.rollup(spark, r)
        assert got.dtypes == want.dtypes
        assert sorted(repr(six(x)) for x in got.collect()) == sorted(repr(six(x)) for x in want.collect())


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_a_small_batch_writes_few_files(spark, scratch):
    from adevents.streaming import rollups as S

    folder, root = scratch + "/parts", scratch + "/root"
    store = P.PreparedStore(root)
    at = lambda d: int(dt.datetime(2024, 6, d, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [(at(1 + i % 28), ["impression", "click", "purchase"][i % 3], float(i % 7)) for i in range(300)]
    for n in range(3):
        _part(spark, folder, n, rows + [("", "impression", 7.0)])
    S.keep_up(spark, folder, root, max_files=1).awaitTermination()
    store.sync(spark)
    # a file or few per batch and table, not one for each type and day
    assert len(_files(f"{root}/events") + _files(f"{root}/events.small")) <= 3 * 8
    for r in ROLLUPS:
        assert [len(_files(p)) for p in store.rollup_paths[r.name]] == [1] * 3
        got = sorted(map(repr, store.rollup(spark, r).collect()))
        assert got == sorted(map(repr, build_rollup(store.events(spark), r).select(*r.dims, *r.stored).collect()))
    assert _answers(spark, store) == [(903, "counts"), (3 * (sum(i % 7 for i in range(0, 300, 3)) + 7.0), "daily_revenue")]


def test_small_and_large_batches_make_one_store(spark, scratch, monkeypatch):
    from adevents.operators.rollups import MERGEABLE
    from adevents.streaming import rollups as S

    tables, store = ROLLUPS + MERGEABLE, P.PreparedStore(scratch)
    monkeypatch.setattr(S, "MERGE_FOLDERS", 3)
    monkeypatch.setattr(S, "SMALL_ROWS", 4)
    # a batch that was written as a small one broke off before its commit, and comes again with more events
    monkeypatch.setattr(manifest, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        S.append_batch(store, _events(spark, [EVENT] * 2), 0, rollups=tables)
    monkeypatch.undo()
    monkeypatch.setattr(S, "MERGE_FOLDERS", 3)
    monkeypatch.setattr(S, "SMALL_ROWS", 4)
    sizes = [6, 2, 1, 0, 5, 3, 4, 9, 1]
    for batch, n in enumerate(sizes):
        rows = [EVENT, (None, "impression", 0.25), ("2024-06-02 10:00:00", "purchase", 0.5)]
        assert S.append_batch(store, _events(spark, (rows * n)[:n]), batch, rollups=tables)
    store.sync(spark)
    events = store.events(spark)
    assert events.count() == sum(sizes) and answer(spark, store, **COUNT)[0].collect()[0][0] == sum(sizes)
    assert _files(f"{scratch}/events") and _files(f"{scratch}/events.small")
    for r in tables:
        want = build_rollup(events, r).select(*r.dims, *r.stored)
        assert sorted(map(repr, store.rollup(spark, r).collect())) == sorted(map(repr, want.collect()))
