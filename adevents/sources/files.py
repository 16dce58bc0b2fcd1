"""Small filesystem helpers shared by the sources (paths, not data)."""

from __future__ import annotations

import fnmatch
import posixpath


#: Standard CSV: quotes are doubled, and a backslash is an ordinary character.
CSV_DIALECT = {"quote": '"', "escape": '"'}


def arrow_csv_options():
    """How Arrow reads event parts as text: only empty fields are NULL, quoted or not."""
    import pyarrow as pa
    import pyarrow.csv as pacsv

    from adevents.schema import RAW_COLUMNS

    return pacsv.ConvertOptions(
        column_types={c: pa.string() for c in RAW_COLUMNS},
        include_columns=list(RAW_COLUMNS),
        include_missing_columns=True,
        strings_can_be_null=True,
        null_values=[""],
        quoted_strings_can_be_null=True,
    )


def arrow_parse_options(multiline: bool):
    import pyarrow.csv as pacsv

    return pacsv.ParseOptions(newlines_in_values=multiline)


def check_line_breaks(rows, multiline: bool):
    """Raises where a value holds a line break that the reader wasn't told to expect."""
    import pyarrow.compute as pc

    if not multiline:
        for column in rows.columns:
            if pc.any(pc.match_substring_regex(column, r"[\r\n]")).as_py():
                raise ValueError("a quoted field holds a line break; read these parts with multiline=True")
    return rows


def exists(spark, path: str) -> bool:
    """Whether Spark finds a folder or file with data at ``path``."""
    from pyspark.errors import AnalysisException

    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").isEmpty()
    except AnalysisException:
        return False


def to_uri(path: str) -> str:
    """Spark's paths as URIs that Arrow opens: ``file:/x`` as ``file:///x``, ``s3a`` as ``s3``."""
    if path.startswith(("s3a://", "s3n://")):
        return "s3" + path[3:]
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    if "://" not in path:
        return "file://" + path
    return path


def open_filesystem(path: str):
    """(pyarrow filesystem, path inside it) for a local path or URI."""
    from pyarrow import fs as pafs

    return pafs.FileSystem.from_uri(to_uri(path))


def is_part_name(name: str, pattern: str) -> bool:
    """Base name matches the part pattern and no path segment is __MACOSX."""
    parts = name.replace("\\", "/").split("/")
    return "__MACOSX" not in parts and fnmatch.fnmatchcase(posixpath.basename(name), pattern)


def attempt_suffix() -> str:
    """A per-task-attempt suffix for temporary output names."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    if ctx is None:
        return ".tmp"
    return f".attempt-{ctx.stageId()}-{ctx.attemptNumber()}-{ctx.taskAttemptId()}.tmp"


def publish(filesystem, tmp: str, final: str) -> None:
    """Move a finished temporary file to its final name (replacing a
    previous attempt's file), so readers never see a half-written part."""
    filesystem.move(tmp, final)
