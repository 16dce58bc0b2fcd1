"""Compare two results as sets of rows, floats rounded to ``digits``.

The check is the one a result verifier needs: same header (names, in
order), same number of distinct rows, and no row on one side only.  Both
sides are tagged and unioned, grouped by every column once (duplicates
collapse map-side), and the per-row membership is summed into a one-row
summary -- one shuffle, no cross join, nothing collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adevents.functions.typing import soft_double
from adevents.sources.files import CSV_DIALECT, exists

_SIDE = "__side"


def normalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating and decimal columns; keep distinct rows."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits).alias(f.name)
        cols.append(c)
    return df.select(*cols).distinct()


def compare_results(a: DataFrame, b: DataFrame, digits: int = 6) -> DataFrame:
    """One row: ``rows_a, rows_b, only_a, only_b, same_header, matched``."""
    same_header = a.columns == b.columns
    if not same_header:
        # different headers: only the distinct-row counts are comparable
        side_a = normalize(a, digits).select(F.lit(1).alias(_SIDE))
        side_b = normalize(b, digits).select(F.lit(2).alias(_SIDE))
        counts = side_a.unionByName(side_b).agg(
            F.count(F.when(F.col(_SIDE) == 1, 1)).alias("rows_a"),
            F.count(F.when(F.col(_SIDE) == 2, 1)).alias("rows_b"),
        )
        return counts.select(
            "rows_a",
            "rows_b",
            F.lit(None).cast("long").alias("only_a"),
            F.lit(None).cast("long").alias("only_b"),
            F.lit(False).alias("same_header"),
            F.lit(False).alias("matched"),
        )
    cols = a.columns
    tagged = normalize(a, digits).withColumn(_SIDE, F.lit(1)).unionByName(
        normalize(b, digits).withColumn(_SIDE, F.lit(2))
    )
    per_row = tagged.groupBy(*cols).agg(
        F.max((F.col(_SIDE) == 1).cast("int")).alias("in_a"),
        F.max((F.col(_SIDE) == 2).cast("int")).alias("in_b"),
    )
    zero = F.lit(0).cast("long")
    summary = per_row.agg(
        F.coalesce(F.sum("in_a").cast("long"), zero).alias("rows_a"),
        F.coalesce(F.sum("in_b").cast("long"), zero).alias("rows_b"),
        F.coalesce(F.sum(F.col("in_a") * (1 - F.col("in_b"))).cast("long"), zero).alias("only_a"),
        F.coalesce(F.sum(F.col("in_b") * (1 - F.col("in_a"))).cast("long"), zero).alias("only_b"),
    )
    return summary.select(
        "*",
        F.lit(True).alias("same_header"),
        ((F.col("only_a") == 0) & (F.col("only_b") == 0)).alias("matched"),
    )


def compare_keyed(a: DataFrame, b: DataFrame, keys: Sequence[str], absolute: float = 0.0, relative: float = 0.0) -> DataFrame:
    """Rows of ``a`` and ``b`` that differ, matched by their keys (null equals null).

    One row per key that is ``missing`` (only in ``a``), ``added`` (only in
    ``b``) or ``changed``, with the number of differing columns and for every
    other column ``c`` of both: ``c_a``, ``c_b``, and for numbers ``c_diff`` and
    ``c_rel`` (the difference over the larger magnitude).  Numbers are equal when
    their difference is at most ``absolute`` or at most ``relative`` of the larger
    magnitude; NaN equals NaN, and null equals null only.  A key that occurs
    twice on a side raises.  One shuffle per side, no rows collected.
    """
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]
    if not keys or set(a.columns) != set(b.columns) or not set(keys) <= set(a.columns):
        raise ValueError(f"both sides need the keys {keys} and equal columns; got {a.columns} and {b.columns}")
    numbers = {f.name for f in a.schema.fields if isinstance(f.dataType, T.NumericType)}
    numbers &= {f.name for f in b.schema.fields if isinstance(f.dataType, T.NumericType)}

    def side(df: DataFrame, name: str) -> DataFrame:
        once = [F.first(c).alias(f"{c}_{name}") for c in values]
        rows = df.groupBy(*[F.col(k).alias(f"{k}__{name}") for k in keys]).agg(F.count(F.lit(1)).alias(f"n__{name}"), *once)
        twice = F.raise_error(F.concat_ws(" ", F.lit("a key occurs twice:"), *[F.col(f"{k}__{name}").cast("string") for k in keys]))
        return rows.withColumn(f"n__{name}", F.when(F.col(f"n__{name}") == 1, F.lit(1)).otherwise(twice.cast("int")))

    same = [F.col(f"{k}__a").eqNullSafe(F.col(f"{k}__b")) for k in keys]
    joined = side(a, "a").join(side(b, "b"), same, "full_outer")
    in_a, in_b = F.col("n__a").isNotNull(), F.col("n__b").isNotNull()
    columns, differ = [], []
    for c in values:
        x, y = F.col(f"{c}_a"), F.col(f"{c}_b")
        columns += [x, y]
        if c in numbers:
            x, y = x.cast("double"), y.cast("double")
            gap, size = F.abs(y - x), F.greatest(F.abs(x), F.abs(y))
            columns += [(y - x).alias(f"{c}_diff"), F.when(size > 0, (y - x) / size).alias(f"{c}_rel")]
            equal = x.eqNullSafe(y) | F.coalesce((gap <= F.lit(float(absolute))) | (gap <= size * F.lit(float(relative))), F.lit(False))
        else:
            equal = x.eqNullSafe(y)
        differ.append((in_a & in_b & ~equal).cast("int"))
    status = F.when(~in_b, "missing").when(~in_a, "added").when(F.col("n_changed") > 0, "changed")
    out = joined.withColumn("n_changed", sum(differ, F.lit(0)))
    key_columns = [F.coalesce(F.col(f"{k}__a"), F.col(f"{k}__b")).alias(k) for k in keys]
    return out.select(*key_columns, status.alias("status"), "n_changed", *columns).where(F.col("status").isNotNull())


def _text_normalized(df: DataFrame, digits: int) -> DataFrame:
    """Text values that parse as numbers are rounded, as a text comparer does."""
    cols = []
    for c in df.columns:
        num = soft_double(F.col(c))
        cols.append(F.when(num.isNotNull(), F.round(num, digits).cast("string")).otherwise(F.col(c)).alias(c))
    return df.select(*cols)


def compare_result_files(spark, path_a: str, path_b: str, digits: int = 6) -> DataFrame:
    """Compare two CSV results (header row, any row order) as sets of rows.

    Values are read as text; every value that parses as a number is rounded
    to ``digits`` places on both sides before the comparison.
    """
    reader = spark.read.options(header=True, inferSchema=False, **CSV_DIALECT)
    a, b = reader.csv(path_a), reader.csv(path_b)
    return compare_results(_text_normalized(a, digits), _text_normalized(b, digits), digits)


_SUMMARY = "rows_a long, rows_b long, only_a long, only_b long, same_header boolean, matched boolean"


def compare_result_folders(spark, dir_a: str, dir_b: str, names, digits: int = 6) -> DataFrame:
    """One row per result name: the comparison of its CSV in both folders.

    ``status`` is PASS or FAIL; a result that a folder lacks is a FAIL row with
    NULL counts.
    """
    rows = None
    for name in names:
        paths = [f"{d.rstrip('/')}/{name}" for d in (dir_a, dir_b)]
        if all(exists(spark, p) for p in paths):
            one = compare_result_files(spark, *paths, digits)
        else:
            one = spark.createDataFrame([(None, None, None, None, False, False)], _SUMMARY)
        one = one.select(
            F.lit(name).alias("query"), "*", F.when(F.col("matched"), "PASS").otherwise("FAIL").alias("status")
        )
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no result names given")
    return rows
