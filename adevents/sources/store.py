"""The event store: Parquet partitioned by ``type`` and ``day``.

Writing rebalances the rows on the partition columns once, so each
``type=/day=`` directory gets few, well-sized files; adaptive execution
splits a hot ``(type, day)`` over several tasks instead of one.  Rows are
sorted inside each task by country and publisher so Parquet row-group
statistics can skip row groups for those filters.

Reading declares the schema (no inference), restores the canonical column
order, and leaves filters on ``type``/``day`` to Catalyst, which turns them
into partition filters: only matching directories are listed and read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adevents.schema import EVENT_COLUMNS, EVENTS_SCHEMA, STORE_PARTITIONS
from adevents.sources import manifest
from adevents.sources.layout import Curve

# Columns after the partition keys used to order rows inside each file.
CLUSTER_COLUMNS = ("country", "publisher_id", "minute")


def write_store(events: DataFrame, path: str, replace: str = "all", curve: Curve | None = None) -> str:
    """Write typed events to the store.

    ``replace="all"`` replaces the whole store; ``replace="partitions"``
    replaces only the ``(type, day)`` directories present in ``events``
    (reloading single days); ``replace="none"`` appends.  The manifest gets
    a new version without summary tables.  With a ``curve`` the rows of a
    partition follow a space-filling curve instead of the sort.
    """
    modes = {"all": "overwrite", "partitions": "overwrite", "none": "append"}
    if replace not in modes:
        raise ValueError(f"replace must be one of {sorted(modes)}")
    if curve:
        laid_out = curve.lay_out(events)
    else:
        laid_out = events.select(*EVENT_COLUMNS).hint("rebalance", *STORE_PARTITIONS).sortWithinPartitions(
            *STORE_PARTITIONS, *CLUSTER_COLUMNS
        )
    writer = (
        laid_out.write.mode(modes[replace])
        .partitionBy(*STORE_PARTITIONS)
        .options(compression="zstd", **(curve.options() if curve else {}))
    )
    if replace == "partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    spark = events.sparkSession
    name = manifest.begin_write(spark, path, whole=replace == "all")
    writer.parquet(path)
    manifest.finish_write(spark, path, name)
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan of the store in canonical column order."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(path).select(*EVENT_COLUMNS)


def batch_folder(path: str, batch: int, small: bool) -> str:
    """Where a batch of a store that is kept up batch by batch lies: small ones beside the store, in files of all types and days."""
    return f"{path.rstrip('/')}{'.small' if small else ''}/batch={batch}"


def read_batches(spark: SparkSession, path: str, last: int) -> DataFrame:
    """Lazy scan of a store kept up batch by batch, up to the given batch, with ``batch``.

    Batches are ``batch=/type=/day=``, or ``batch=`` alone beside the store
    (:func:`batch_folder`).
    """
    schema = T.StructType([*EVENTS_SCHEMA.fields, T.StructField("batch", T.LongType())])
    roots = [batch_folder(path, last, small).rsplit("/", 1)[0] for small in (False, True)]
    found = [r for r in roots if manifest.subfolders(spark, r)] or roots[:1]
    scans = [spark.read.schema(schema).parquet(r).where(F.col("batch") <= last).select(*schema.names) for r in found]
    return reduce(DataFrame.unionByName, scans)


def register_events(df: DataFrame, name: str = "events") -> DataFrame:
    """Expose a frame to SQL as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def store_inventory(store: DataFrame, with_files: bool = True) -> DataFrame:
    """Rows (and files) per ``(type, day)`` partition of a store scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if with_files:
        aggs.append(F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))
    return store.groupBy(*STORE_PARTITIONS).agg(*aggs)


def row_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
