"""Rows of the store in the order of a space-filling curve.

Rows sorted by country, publisher and minute are close together only for a
filter on country; the row groups' bounds of the later columns span nearly
everything.  Here every column's values are dealt into ``2**bits`` buckets of
about equally many rows, and rows are ordered by the buckets' interleaved bits,
so a row group holds a small range of *every* column and a filter on any of
them skips row groups.

The bounds of the buckets are exact and need no window over all rows: values
are counted (a partial aggregate), the counts are written range-partitioned,
and running sums inside each partition start from the totals of the partitions
before it.  At most ``2**bits`` bounds of a column reach the driver.

NULLs share the first bucket, and a value held by many rows is one bucket.
Rows of one ``(type, day)`` are range-partitioned along the curve, so each file
is one stretch of it, and a hot ``(type, day)`` is spread over many tasks; a
hash of the row breaks ties, so a bucket of any size can be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adevents.schema import EVENT_COLUMNS, STORE_PARTITIONS
from adevents.session import scratch_path

_X, _C, _P, _UPTO, _BUCKET, _CURVE, _TIE = "__x", "__c", "__p", "__upto", "__bucket", "__curve", "__tie"

# The dimensions of the curve. Days are directories already, so the minute counts as a time of day.
DIMENSIONS = ("country", "publisher_id", "substring(minute, 12, 5)")


def bucket_bounds(df: DataFrame, value: Column, bits: int) -> list[tuple[int, object]]:
    """``(bucket, smallest value)`` of each bucket in use, in ascending order; a value's bucket is its share of smaller rows."""
    spark = df.sparkSession
    counts = df.select(value.alias(_X)).where(F.col(_X).isNotNull()).groupBy(_X).agg(F.count(F.lit(1)).alias(_C))
    ranged = counts.repartitionByRange(_X).withColumn(_P, F.spark_partition_id())
    path = scratch_path(spark, "bounds")
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    # one row per range partition
    parts = stored.groupBy(_P).agg(F.sum(_C).alias("__t"))
    before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(_P, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias(_UPTO), F.sum("__t").over(Window.partitionBy()).alias("__n"))
    inside = Window.partitionBy(_P).orderBy(_X).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col(_UPTO) + F.coalesce(F.sum(_C).over(inside), F.lit(0))
    placed = stored.join(parts, _P).select(F.floor(smaller / F.col("__n") * F.lit(1 << bits)).cast("int").alias(_BUCKET), _X)
    return [tuple(r) for r in placed.groupBy(_BUCKET).agg(F.min(_X).alias(_X)).orderBy(_BUCKET).collect()]


def bucket_of(value: Column, bounds: Sequence[tuple[int, object]]) -> Column:
    """The bucket of a value: a binary search for the last bound that isn't above it; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    smallest = F.array(*[F.lit(x) for _, x in bounds])
    step_on = lambda at, step: at + F.when(value >= F.get(smallest, at + step - 1), step).otherwise(0)
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step_on)
    return F.coalesce(F.get(F.array(*[F.lit(b) for b, _ in bounds]), found - 1), F.lit(0))


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """One long of the buckets' bits in turn, the highest bits first."""
    n = len(buckets)
    if n * bits > 63:
        raise ValueError(f"{n} dimensions of {bits} bits don't fit a long")
    turns = [
        F.shiftleft(F.shiftright(b.cast("long"), i).bitwiseAND(F.lit(1)), i * n + n - 1 - j)
        for i in range(bits)
        for j, b in enumerate(buckets)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), turns)


@dataclass(frozen=True)
class Curve:
    """The order of the rows inside the store's partitions: SQL expressions of the dimensions, and bits of each.

    ``row_group_rows`` limits the rows of a row group (None: Parquet's size in bytes alone).
    """

    dimensions: tuple[str, ...] = DIMENSIONS
    bits: int = 8
    row_group_rows: int | None = None

    def lay_out(self, events: DataFrame) -> DataFrame:
        """The rows dealt and sorted along the curve. ``events`` is scanned once per dimension, for that column alone, then twice."""
        rows = events.select(*EVENT_COLUMNS)
        values = [F.expr(d) for d in self.dimensions]
        names = [f"{_BUCKET}_{i}" for i in range(len(values))]
        placed = rows.withColumns({n: bucket_of(v, bucket_bounds(rows, v, self.bits)) for n, v in zip(names, values)})
        curve = interleave([F.col(n) for n in names], self.bits)
        keyed = placed.withColumns({_CURVE: curve, _TIE: F.xxhash64(*EVENT_COLUMNS)})
        order = (*STORE_PARTITIONS, _CURVE, _TIE)
        return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(*EVENT_COLUMNS)

    def options(self) -> dict[str, str]:
        return {} if self.row_group_rows is None else {"parquet.block.row.count.limit": str(self.row_group_rows)}
