"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.session import prepare_session, scratch_path

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back.

    Cuts the lineage: every later job reads the same committed rows, so a lost
    executor or a second evaluation cannot change them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def words_of(text: Column) -> Column:
    """The words of a text (never null when the text is not)."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """Number of words, without building a filtered array."""
    parts = F.split(text, SPACE_CLASS)
    return F.transform(
        F.array(parts),
        lambda p: F.size(p).cast("long")
        - F.when(F.get(p, F.lit(0)) == "", 1).otherwise(0)
        - F.when((F.size(p) > 1) & (F.get(p, F.size(p) - 1) == ""), 1).otherwise(0),
    )[0]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.transform(F.array(value), body)[0]


def crc32_of(column: Column) -> Column:
    """Unsigned crc32 of a text's UTF-8 bytes."""
    return F.crc32(column.cast("binary"))


def remainder_of(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


#: Bits of a row number for the row's place in its file; those above number the file.
_PLACE_BITS = 40


def as_table(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a scan of Parquet files, else :func:`saved`."""
    if {"file_path", "row_index"} <= _metadata_fields(df):
        return df
    return saved(df, "table")


def _metadata_fields(df: DataFrame) -> set[str]:
    try:
        return set(df.select("_metadata").schema[0].dataType.names)
    except AnalysisException:
        return set()


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A number per row that is unique even among repeated rows.

    It is made of the row's file and place in it, so every scan gives a row
    the same number, however the files are split and however many cores there
    are.  ``df`` is a scan of Parquet files (:func:`as_table`), of which
    columns and rows may have been left out.  The files are numbered by their
    sorted paths: one row per file is broadcast, as in the scan's own listing.
    """
    if not {"file_path", "row_index"} <= _metadata_fields(df):
        raise ValueError("rows are numbered by their Parquet files; write the table first (as_table)")
    path, place, number = (spare_name(df, c) for c in ("file_path", "row_index", "file_number"))
    rows = df.withColumns({path: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")})
    files = sorted(r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect())
    numbers = df.sparkSession.createDataFrame(list(enumerate(files)), f"`{number}` long, `{path}` string")
    row_id = F.shiftleft(F.col(number), _PLACE_BITS) + F.col(place)
    return rows.join(F.broadcast(numbers), path).select(*[F.col(f"`{c}`") for c in df.columns], row_id.alias(name))


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name
