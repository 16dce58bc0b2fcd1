"""Reading event parts with bad lines set aside instead of failing the read.

Every line below a header is in exactly one of two outputs: the typed events,
or the quarantine with its file, its text and the reasons.  A line is bad when it
has not as many fields as its part's header, or a price that is no number.
(Malformed ids and times are soft: they become NULL in good rows.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adevents.functions.typing import soft_double, type_events
from adevents.schema import PART_GLOB, RAW_COLUMNS
from adevents.sources.csv_parts import part_headers
from adevents.sources.files import CSV_DIALECT

PRICES = ("bid_price", "total_price")
_LINE = "_line"


def _scan(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, _LINE]])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, columnPruning=False, **CSV_DIALECT
    )
    rows = reader.csv(paths)  # all columns are parsed, since fields are only counted then
    fields = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), CSV_DIALECT)
    wrong = F.when(F.col(_LINE).isNotNull(), F.lit("wrong number of fields"))
    prices = [
        F.when(F.col(_LINE).isNull() & (F.col(c) != "") & soft_double(F.col(c)).isNull(), F.lit(f"malformed {c}"))
        for c in PRICES
        if c in names
    ]
    return rows.select(
        *[F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS],
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(_LINE), fields).alias("line"),
        F.nullif(F.concat_ws("; ", wrong, *prices), F.lit("")).alias("reason"),
    )


def read_with_quarantine(spark: SparkSession, folder: str, pattern: str = PART_GLOB) -> tuple[DataFrame, DataFrame]:
    """``(typed events, quarantine)``; the quarantine has ``file, line, reason``.

    Raises ``FileNotFoundError`` when no part has a header.
    """
    by_layout: dict[str, list[str]] = {}
    for r in part_headers(spark, folder, pattern).where(F.col("header").isNotNull()).collect():  # one row per part
        by_layout.setdefault(r.header, []).append(r.path)
    if not by_layout:
        raise FileNotFoundError(f"no {pattern} with a header in {folder}")
    scans = [_scan(spark, sorted(paths), header.split("\x1f")) for header, paths in sorted(by_layout.items())]
    rows = reduce(lambda a, b: a.unionByName(b), scans)
    good = type_events(rows.where(F.col("reason").isNull()).select(*RAW_COLUMNS))
    return good, rows.where(F.col("reason").isNotNull()).select("file", "line", "reason")


def store_with_quarantine(spark: SparkSession, folder: str, store: str, quarantine: str, pattern: str = PART_GLOB) -> None:
    """Writes good rows to the store at ``store`` and bad lines to the Parquet table ``quarantine``."""
    from adevents.sources.store import write_store

    good, bad = read_with_quarantine(spark, folder, pattern)
    bad.write.mode("overwrite").parquet(quarantine)
    write_store(good, store)
