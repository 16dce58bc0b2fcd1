"""Event parts inside zip archives.

A zip member cannot be split, so the unit of parallelism is the member: Spark
lists the archives, tasks read their central directories, and the members are
dealt over the cluster; each task opens its archive on shared storage and
streams its members as Arrow record batches of text columns, assigned by header
name.  Members whose base name does not match ``events_part_*.csv`` and anything
under ``__MACOSX/`` are skipped.
"""

from __future__ import annotations

import zipfile

from pyspark.sql import DataFrame, SparkSession

from adevents.schema import PART_GLOB, RAW_COLUMNS, RAW_SCHEMA
from adevents.sources.files import arrow_csv_options, arrow_parse_options, attempt_suffix, check_line_breaks, is_part_name, open_filesystem, publish

_BATCH_BYTES = 8 << 20


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """The archives at a path: one file, a folder of ``*.zip`` or a glob (``path``, with its scheme)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")


def _members_of(pattern: str):
    def members(batches):
        import pyarrow as pa

        for batch in batches:
            for archive in batch.column("path").to_pylist():
                filesystem, inner = open_filesystem(archive)
                with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as zf:
                    names = sorted(n for n in zf.namelist() if is_part_name(n, pattern))
                yield pa.RecordBatch.from_pydict(
                    {"archive": [archive] * len(names), "member": names},
                    schema=pa.schema([("archive", pa.string()), ("member", pa.string())]),
                )

    return members


def _member_reader(multiline: bool):
    def read_members(batches):
        import pyarrow.csv as pacsv

        convert, parse = arrow_csv_options(), arrow_parse_options(multiline)
        for batch in batches:
            for archive, name in zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist()):
                filesystem, inner = open_filesystem(archive)
                with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as zf, zf.open(name) as member:
                    if not member.peek(1):
                        continue
                    read = pacsv.ReadOptions(block_size=_BATCH_BYTES)
                    for rows in pacsv.open_csv(member, read_options=read, parse_options=parse, convert_options=convert):
                        if rows.num_rows:
                            yield check_line_breaks(rows, multiline)

    return read_members


def read_event_zip(spark: SparkSession, path: str, pattern: str = PART_GLOB, multiline: bool = False) -> DataFrame:
    """Raw text events from a zip archive (or a folder / glob of archives).

    Raises ``FileNotFoundError`` when no archive holds a matching member.
    Quoted fields with line breaks are kept with ``multiline=True`` and fail
    the read without, as in the CSV reader.
    """
    members = list_archives(spark, path).mapInArrow(_members_of(pattern), "archive string, member string")
    if members.isEmpty():
        raise FileNotFoundError(f"no {pattern} member in {path}")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(width, "archive", "member").mapInArrow(_member_reader(multiline), RAW_SCHEMA)


def _zip_writer(folder: str, junk_member: bool):
    def write(batches):
        import io

        import pyarrow as pa
        import pyarrow.csv as pacsv

        filesystem, root = open_filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        out = zf = stream = None
        name, tmp, rows = None, None, 0
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                first = stream is None
                if first:
                    pid = batch.column("__pid")[0].as_py()
                    name = f"events_{pid:05d}.zip"
                    tmp = f"{root}/{name}{attempt_suffix()}"
                    out = filesystem.open_output_stream(tmp)
                    zf = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED)
                    stream = zf.open(f"events_part_{pid:05d}.csv", "w", force_zip64=True)
                text = io.BytesIO()
                cols = [batch.column(c) for c in RAW_COLUMNS]
                pacsv.write_csv(
                    pa.RecordBatch.from_arrays(cols, names=list(RAW_COLUMNS)),
                    text,
                    write_options=pacsv.WriteOptions(include_header=first, quoting_style="needed"),
                )
                stream.write(text.getvalue())
                rows += batch.num_rows
            if stream is not None:
                stream.close()
                stream = None
                if junk_member:
                    # An archiver's resource-fork copy; a reader must skip it
                    # (its malformed price would fail the strict cast).
                    bad = ",".join(RAW_COLUMNS) + "\n0,impression,x,1,1,not-a-price,1,,US\n"
                    zf.writestr(f"__MACOSX/events_part_{name[7:12]}.csv", bad)
        finally:
            if stream is not None:
                stream.close()
            if zf is not None:
                zf.close()
            if out is not None:
                out.close()
        if name is not None:
            publish(filesystem, tmp, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [rows]}, schema=pa.schema([("file", pa.string()), ("rows", pa.int64())]))

    return write


def write_event_zips(raw: DataFrame, folder: str, junk_member: bool = True) -> list:
    """Write raw text events as one zip archive per task (executor side)."""
    from pyspark.sql import functions as F

    filesystem, root = open_filesystem(folder)
    filesystem.create_dir(root, recursive=True)
    written = raw.select(*RAW_COLUMNS).withColumn("__pid", F.spark_partition_id()).mapInArrow(
        _zip_writer(folder, junk_member), "file string, rows long"
    )
    return written.collect()
