"""Contiguous shards of near-equal byte size from global prefix sums.

Rows are range-partitioned by ``doc_id`` without their text, written once,
and each part's byte and row totals (one row per part) give every part its
start in the global order.  A row's start is its part's start plus a running
sum inside the part, so no task sees more than one part.  Shard ``i`` takes
the rows whose middle byte lies in the ``i``-th of ``n`` equal byte ranges.

Cases: a null text has no bytes (its crc32 is that of the empty text), a null
``doc_id`` sorts first, repeated ids are ordered by crc32 and size (rows equal
in all three are interchangeable), an empty table gives no rows, further
columns are left out of the digest and kept by :func:`shard_documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adevents.llm.common import as_table, crc32_of, saved, spare_name, text_or_empty, with_row_id

ROW_OVERHEAD = 8


def _ordered_parts(rows: DataFrame) -> DataFrame:
    """``rows`` range-partitioned by their order, with the part's number, on storage."""
    ranged = rows.repartitionByRange("doc_id", "text_crc32", "size")
    return saved(ranged.withColumn("part", F.spark_partition_id()), "shards")


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """Adds ``start`` (bytes before the row), ``position``, ``shard`` and ``slot``.

    ``rows`` has ``doc_id``, ``text_crc32``, ``size`` and any payload columns.
    """
    parts = _ordered_parts(rows)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (  # one row per part: bounded by the number of shuffle partitions
        parts.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("part_start"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("part_position"),
            F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"),
        )
    )
    inside = (
        Window.partitionBy("part")
        .orderBy("doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        parts.withColumns(
            {"up_to": F.sum("size").over(inside), "nth": F.row_number().over(inside)}
        )
        .join(F.broadcast(totals), "part")
        .withColumn("start", F.col("part_start") + F.col("up_to") - F.col("size"))
        .withColumn("position", F.col("part_position") + F.col("nth") - 1)
        .withColumn(
            "shard",
            F.least(
                F.expr(f"((2 * start + size) * {shards}) div greatest(2 * all_bytes, 1)"),
                F.lit(shards - 1),
            ).cast("int"),
        )
    )
    placed = saved(placed.drop("part", "part_start", "part_position", "all_bytes", "up_to", "nth"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("position") - F.col("first")).drop("first")


def _sized(docs: DataFrame, *more) -> DataFrame:
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text_or_empty()) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        crc32_of(text_or_empty()).alias("text_crc32"),
        *more,
    )


def shard_digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: its size, crc32, shard and slot (``bytes`` law)."""
    return assign(_sized(docs), shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "start",
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``docs`` with all its columns, plus ``shard`` and ``slot``.

    A column of that name in ``docs`` is replaced.
    """
    kept = as_table(docs).drop("shard", "slot")
    key = spare_name(kept, "row_id")
    placed = assign(_sized(with_row_id(kept, key), F.col(key).alias("row_id")), shards)
    placed = placed.select(F.col("row_id").alias(key), "shard", "slot")
    return with_row_id(kept, key).join(placed, key).drop(key)


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """``docs`` written under ``path/shard=<i>/``, rows in slot order within each file."""
    placed = shard_documents(docs, shards)
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
