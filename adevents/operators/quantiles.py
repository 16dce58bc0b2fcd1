"""Exact medians per group, without gathering a group in one task.

Spark's built-in ``median``/``percentile`` merge every distinct value of a
group in a single task, so one hot group with many distinct values can
exhaust that task.  Here the rows are first counted per group and value (a
partial aggregate), and these counts are written range-partitioned by group
and value.  From then on only counts are looked at:

1. every range partition's total per group (one row per partition and group)
   gives, by a running sum over the partitions of a group, the partition that
   holds each of the two middle ranks;
2. only those partitions' rows are ranked, inside their partition.

The raw values are shuffled once, behind the partial aggregate; no window holds
more than one range partition of a group, and a group of any size is spread
over the partitions its values fill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_X, _C, _P, _T, _R, _N, _UPTO = "__x", "__c", "__p", "__t", "__r", "__n", "__upto"


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which NULL keys match; the keys are kept once."""
    other = right.withColumnsRenamed({k: f"__other_{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"__other_{i}")) for i, k in enumerate(keys)]
    return left.join(other, reduce(lambda a, b: a & b, same), how).drop(*[f"__other_{i}" for i in range(len(keys))])


def _ranged_counts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``keys, value, count, part`` on storage, range-partitioned by keys and value."""
    from adevents.session import scratch_path

    # + 0.0 makes -0.0 an ordinary zero
    counts = df.select(*keys, (value.cast("double") + F.lit(0.0)).alias(_X)).groupBy(*keys, _X).agg(F.count(F.lit(1)).alias(_C))
    ranged = counts.repartitionByRange(*keys, _X).withColumn(_P, F.spark_partition_id())
    path = scratch_path(df.sparkSession, "median")
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def exact_median(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """One row per group of ``keys``: the exact median of ``col`` as ``name``.

    The lower and upper middle values are averaged.  Groups whose values are
    all NULL get NULL; no ``keys`` means one row.  NaN counts as the largest value.
    """
    keys = list(keys)
    every = _ranged_counts(df, keys, F.col(col))
    counts = every.where(F.col(_X).isNotNull())
    group = Window.partitionBy(*keys) if keys else Window.partitionBy()
    parts = counts.groupBy(*keys, _P).agg(F.sum(_C).alias(_C))
    parts = parts.withColumn(_N, F.sum(_C).over(group)).withColumn(
        _UPTO, F.sum(_C).over(group.orderBy(_P).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    ranks = F.array(F.floor((F.col(_N) + 1) / 2), F.floor(F.col(_N) / 2) + 1)
    wanted = (
        parts.select(*keys, _P, _C, _UPTO, F.posexplode(ranks).alias(_T, _R))
        .where((F.col(_UPTO) - F.col(_C) < F.col(_R)) & (F.col(_R) <= F.col(_UPTO)))
        .select(*keys, _P, _T, (F.col(_R) - (F.col(_UPTO) - F.col(_C))).alias(_R))
    )
    held = _join(counts, wanted, [*keys, _P])
    inside = Window.partitionBy(*keys, _P, _T).orderBy(_X).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = held.withColumn(_UPTO, F.sum(_C).over(inside)).where(
        (F.col(_UPTO) - F.col(_C) < F.col(_R)) & (F.col(_R) <= F.col(_UPTO))
    )
    lower, upper = (F.max(F.when(F.col(_T) == t, F.col(_X))) for t in (0, 1))
    middle = (lower * 0.5 + upper * 0.5).alias(name)
    if not keys:
        return found.agg(middle)
    medians = found.groupBy(*keys).agg(middle)
    return _join(every.select(*keys).distinct(), medians, keys, "left")


_COL = "__col"


def exact_medians(df: DataFrame, keys: Sequence[str], cols: Sequence[tuple[str, str]]) -> DataFrame:
    """Medians of several columns at once: ``cols`` holds ``(column, output name)`` pairs.

    The columns are stacked into rows with the column's number as one more
    group key, and the results are pivoted back to one row per group.
    """
    keys = list(keys)
    if len(cols) == 1:
        return exact_median(df, keys, cols[0][0], cols[0][1])
    values = F.array(*[F.struct(F.lit(i).alias(_COL), F.col(c).cast("double").alias(_X)) for i, (c, _) in enumerate(cols)])
    stacked = df.select(*keys, F.explode(values).alias("__cv")).select(*keys, f"__cv.{_COL}", f"__cv.{_X}")
    med = exact_median(stacked, [*keys, _COL], _X, "__m")
    pivot = [F.max(F.when(F.col(_COL) == i, F.col("__m"))).alias(name) for i, (_, name) in enumerate(cols)]
    return med.groupBy(*keys).agg(*pivot) if keys else med.agg(*pivot)
