"""Quoted line breaks: one behaviour in all four readers."""

from __future__ import annotations

import os
import zipfile

import pytest

from adevents.schema import RAW_COLUMNS
from adevents.sources.csv_parts import read_event_parts
from adevents.sources.store import read_store
from adevents.sources.zip_parts import read_event_zip
from adevents.streaming.ingest import catch_up

TEXT = ",".join(RAW_COLUMNS) + "\n" + '1704067200000,impression,"a\nb",1,2,0.5,3,,US\n1704067200000,click,c,1,2,,3,,"J, ""P"""\n'


def _read(spark, reader, folder, scratch, multiline):
    if reader == "csv":
        return read_event_parts(spark, folder, multiline=multiline)
    if reader == "zip":
        return read_event_zip(spark, folder, multiline=multiline)
    catch_up(spark, folder, f"{scratch}/store", f"{scratch}/checkpoint", by_name=reader == "by_name", multiline=multiline)
    return read_store(spark, f"{scratch}/store")


@pytest.mark.parametrize("reader", ["csv", "zip", "stream", "by_name"])
def test_quoted_line_breaks(spark, scratch, reader):
    folder = f"{scratch}/parts"
    os.makedirs(folder)
    if reader == "zip":
        with zipfile.ZipFile(f"{folder}/x.zip", "w") as z:
            z.writestr("events_part_0.csv", TEXT)
    else:
        with open(f"{folder}/events_part_0.csv", "w") as f:
            f.write(TEXT)
    with pytest.raises(Exception):
        _read(spark, reader, folder, f"{scratch}/without", False).collect()
    got = _read(spark, reader, folder, f"{scratch}/with", True).select("auction_id", "country").collect()
    assert sorted(map(tuple, got)) == [("a\nb", "US"), ("c", 'J, "P"')]
