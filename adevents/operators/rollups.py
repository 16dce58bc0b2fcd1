"""Summary tables (rollups) and reports answered from them.

A :class:`Rollup` declares a grain (``dims``), stored measures and the
fixed filter it was built with.  :func:`build_rollup` is one partial +
final hash aggregation over the events; :func:`rollup_report` answers a
report from a rollup after checking that the rollup covers every clause:

* the rollup's fixed filter must be among the report's conditions, and
  every other condition must be on a dimension;
* grouping keys must be dimensions;
* each aggregate must be derivable from stored measures: ``SUM`` and
  ``COUNT`` re-aggregate as sums of the stored sums and counts, ``MIN`` /
  ``MAX`` as min / max, ``AVG`` as stored sum / stored count, spreads from
  stored moments, ``COUNT(DISTINCT id)`` from stored bitmaps (exact, for
  integers) and bounds of quantiles from stored histograms.

A report that is not covered raises :class:`NotCovered`; no clause is ever
dropped.  When the report groups by the full grain the stored rows are the
answer and no shuffle is planned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adevents.functions.aggregates import AggItem
from adevents.functions.predicates import apply_filters
from adevents.operators.report import Spec, _order_key, finish, named, output_names, spec
from adevents.schema import EVENTS_SCHEMA


class NotCovered(ValueError):
    """The rollup cannot answer the report exactly."""


#: Measures that keep a row per bucket of values, and that row's bucket.
_BUCKETED = ("distinct", "histogram")
BUCKET = "bucket"


def moment_columns(name: str) -> list[str]:
    """Count, mean, and sum of squared differences from the mean."""
    return [f"{name}_n", f"{name}_mean", f"{name}_m2"]


@dataclass(frozen=True)
class Rollup:
    name: str
    dims: tuple[str, ...]
    # (stored column, function, source column); function in sum/count/min/max/moments,
    # or a single one of distinct/histogram, which keep a row per bucket
    measures: tuple[tuple[str, str, str], ...]
    where: tuple = ()
    partition_by: tuple[str, ...] = ()
    # order of rows inside each file, for Parquet row-group skipping
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self):
        if any(f in _BUCKETED for _, f, _ in self.measures) and len(self.measures) > 1:
            raise ValueError(f"{self.name}: a bucketed measure needs a summary table of its own")

    @property
    def bucketed(self) -> bool:
        return self.measures[0][1] in _BUCKETED

    @property
    def stored(self) -> list[str]:
        """Names of the stored measure columns."""
        names = [BUCKET] if self.bucketed else []
        for name, func, _ in self.measures:
            names += moment_columns(name) if func == "moments" else [name]
        return names

    def measure(self, func: str, col: str) -> str | None:
        for stored, f, c in self.measures:
            if f == func and c == col:
                return stored
        return None


_IMPRESSIONS = ({"col": "type", "op": "eq", "val": "impression"},)
_PURCHASES = ({"col": "type", "op": "eq", "val": "purchase"},)

# The measures of the prepared store's three summary tables.  All
# are kept by day, so a refresh reads only the days that changed, and coarser
# reports re-aggregate.
COUNTS = Rollup("counts", ("day", "advertiser_id", "type"), (("event_count", "count", "*"),), partition_by=("day",))
REVENUE = Rollup(
    "revenue",
    ("minute", "day", "publisher_id", "country"),
    (("total_revenue", "sum", "bid_price"),),
    where=_IMPRESSIONS,
    partition_by=("day",),
    cluster_by=("country", "publisher_id", "minute"),
)
PURCHASES = Rollup(
    "purchases",
    ("day", "country"),
    (("sum_of_price", "sum", "total_price"), ("count_of_purchases", "count", "total_price")),
    where=_PURCHASES,
    partition_by=("day",),
)
# The minute grain hardly shrinks the impressions; reports that don't need
# minutes have a table without them.
DAILY_REVENUE = Rollup(
    "daily_revenue",
    ("day", "publisher_id", "country"),
    (("total_revenue", "sum", "bid_price"),),
    where=_IMPRESSIONS,
    partition_by=("day",),
    cluster_by=("country", "publisher_id"),
)
ROLLUPS = (COUNTS, REVENUE, PURCHASES, DAILY_REVENUE)
# Tables with mergeable measures, built on request.
USERS = Rollup("users", ("day", "type", "country"), (("users", "distinct", "user_id"),), partition_by=("day",))
BIDS = Rollup(
    "bids", ("day", "country", "advertiser_id"), (("bid", "moments", "bid_price"), ("price", "moments", "total_price")), partition_by=("day",)
)
BID_VALUES = Rollup("bid_values", ("day", "country"), (("bids", "histogram", "bid_price"),), where=_IMPRESSIONS, partition_by=("day",))
MERGEABLE = (USERS, BIDS, BID_VALUES)

_BUILD = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def build_rollup(events: DataFrame, rollup: Rollup) -> DataFrame:
    """Aggregate the events to the rollup's grain (lazy)."""
    df = apply_filters(events, rollup.where)
    aggs, keys = [], [F.col(d) for d in rollup.dims]
    for stored, func, col in rollup.measures:
        source = F.lit(1) if col == "*" else F.col(col)
        if func == "distinct":
            source = source.cast("long")
            keys.append(F.bitmap_bucket_number(source).alias(BUCKET))
            aggs.append(F.bitmap_construct_agg(F.bitmap_bit_position(source)).alias(stored))
        elif func == "histogram":
            keys.append(value_bucket(source).alias(BUCKET))
            aggs.append(F.count(source).alias(stored))
        elif func == "moments":
            n, mean, m2 = moment_columns(stored)
            source = source.cast("double")
            aggs += [F.count(source).alias(n), F.avg(source).alias(mean), (F.var_pop(source) * F.count(source)).alias(m2)]
        else:
            aggs.append(_BUILD[func](source).alias(stored))
    return df.groupBy(*keys).agg(*aggs)


def folder_name(small: bool) -> str:
    """A new name for a folder of a rollup."""
    return ("small-" if small else "") + uuid.uuid4().hex


def _small(path: str) -> bool:
    return path.rstrip("/").rsplit("/", 1)[-1].startswith("small-")


def write_rollup(table: DataFrame, rollup: Rollup, path: str) -> str:
    """Write a rollup as Parquet, partitioned by its ``partition_by`` dims."""
    write_counted(table, rollup, path)
    return path


def write_counted(table: DataFrame, rollup: Rollup, path: str) -> int:
    """:func:`write_rollup`; gives the rows, counted by the write itself.

    A table of one task for a folder named by :func:`folder_name` as small becomes
    one sorted file, which keeps the partition dims as columns.
    """
    rows, small = Observation(), _small(path)
    writer = table.observe(rows, F.count(F.lit(1)).alias("n"))
    order = list(rollup.cluster_by) or [d for d in rollup.dims if d not in rollup.partition_by]
    if small:
        writer = writer.sortWithinPartitions(*rollup.partition_by, *order)
    elif rollup.partition_by:
        # One shuffle on the partition dims keeps files per directory few;
        # adaptive execution splits a skewed dim value over several tasks.
        writer = writer.hint("rebalance", *rollup.partition_by).sortWithinPartitions(*rollup.partition_by, *order)
    w = writer.write.mode("overwrite").option("compression", "zstd")
    if rollup.partition_by and not small:
        w = w.partitionBy(*rollup.partition_by)
    w.parquet(path)
    return int(rows.get["n"])


def rollup_schema(spark: SparkSession, rollup: Rollup) -> T.StructType:
    """It follows from the declaration, since a rollup may have no rows."""
    return build_rollup(spark.createDataFrame([], EVENTS_SCHEMA), rollup).schema


def read_rollup(spark: SparkSession, rollup: Rollup, path: str) -> DataFrame:
    """Lazy scan of one folder of a rollup."""
    return read_snapshot(spark, rollup, [(path, ())])


def read_snapshot(spark: SparkSession, rollup: Rollup, folders: Iterable[tuple[str, Iterable[str | None]]]) -> DataFrame:
    """Lazy scan of a rollup's folders, each without the days that later folders replace (pruned partitions)."""
    schema = rollup_schema(spark, rollup)
    out = None
    scans: dict[tuple, list[str]] = {}
    for path, without in folders:  # small ones have no partitions, so one scan reads many
        without = tuple(without)
        scans.setdefault(("small" if _small(path) else path, without), []).append(path)
    for (_, without), paths in scans.items():
        df = spark.read.schema(schema).parquet(*paths).select(*rollup.dims, *rollup.stored)
        known = [F.lit(d).cast("date") for d in without if d is not None]
        if known:
            df = df.where(F.col("day").isNull() | ~F.col("day").isin(*known))
        if None in without:
            df = df.where(F.col("day").isNotNull())
        out = df if out is None else out.unionByName(df)
    return out


def merge_rollup(table: DataFrame, rollup: Rollup) -> DataFrame:
    """Partial rows of a rollup (of disjoint sets of events) as one row per group."""
    keys = [*rollup.dims, BUCKET] if rollup.bucketed else list(rollup.dims)
    merge = {"sum": F.sum, "count": F.sum, "histogram": F.sum, "min": F.min, "max": F.max, "distinct": F.bitmap_or_agg}
    aggs, spreads = [], {}
    for stored, func, _ in rollup.measures:
        if func != "moments":
            aggs.append(merge[func](stored).alias(stored))
            continue
        n, mean, m2 = moment_columns(stored)
        weighted = F.sum(F.when(F.col(n) > 0, F.col(n) * F.col(mean)))
        aggs += [F.sum(n).alias(n), (weighted / F.nullif(F.sum(n), F.lit(0))).alias(mean)]
        # a group has at most one partial row per folder
        aggs.append(F.collect_list(F.when(F.col(n) > 0, F.struct(n, mean, m2))).alias(m2))
        spreads[m2] = F.when(F.col(n) > 0, F.aggregate(m2, F.lit(0.0), _spread_around(n, mean, m2)))
    return table.groupBy(*keys).agg(*aggs).withColumns(spreads).select(*rollup.dims, *rollup.stored)


def _spread_around(n: str, mean: str, m2: str):
    def add(total: Column, part: Column) -> Column:
        apart = part[mean] - F.col(mean)
        return total + part[m2] + part[n] * apart * apart

    return add


# Stored measures each derivable aggregate needs.
_NEEDS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "avg": ("sum", "count")}
# Spreads from moments: whether the divisor is one less than the count, and whether a root is taken.
_SPREADS = {"variance": (True, False), "var_pop": (False, False), "stddev": (True, True), "stddev_pop": (False, True)}
_NEEDS |= dict.fromkeys(_SPREADS, ("moments",)) | {"count_distinct": ("distinct",)}


def _check_derivable(rollup: Rollup, agg: AggItem) -> None:
    if agg.func not in _NEEDS:
        raise NotCovered(f"{agg.func}({agg.col}) cannot be derived from a rollup")
    for func in _NEEDS[agg.func]:
        if rollup.measure(func, agg.col) is None:
            raise NotCovered(f"{rollup.name} has no {func}({agg.col}) for {agg.func}({agg.col})")


def _derive(rollup: Rollup, agg: AggItem, regroup: bool) -> Column:
    """Column computing ``agg`` from stored measures (raises if impossible)."""

    def need(func: str) -> Column:
        stored = rollup.measure(func, agg.col)
        if stored is None:
            raise NotCovered(f"{rollup.name} has no {func}({agg.col}) for {agg.func}({agg.col})")
        return F.col(stored)

    if agg.func == "sum":
        c = need("sum")
        return (F.sum(c) if regroup else c).alias(agg.name)
    if agg.func == "count":  # a count of no rows is 0, a sum of no rows NULL
        c = need("count")
        return (F.coalesce(F.sum(c), F.lit(0).cast("long")) if regroup else c).alias(agg.name)
    if agg.func in ("min", "max"):
        c = need(agg.func)
        return ((F.min(c) if agg.func == "min" else F.max(c)) if regroup else c).alias(agg.name)
    if agg.func == "avg":
        s, n = need("sum"), need("count")
        if regroup:
            s, n = F.sum(s), F.sum(n)
        return F.try_divide(s, n).alias(agg.name)
    raise NotCovered(f"{agg.func}({agg.col}) cannot be derived from a rollup")


def _spread(rollup: Rollup, agg: AggItem, prefix: str = "") -> Column:
    """A spread from one row's moments; null where there are too few values."""
    n, _, m2 = (F.col(prefix + c) for c in moment_columns(rollup.measure("moments", agg.col)))
    less_one, root = _SPREADS[agg.func]
    divisor = n - 1 if less_one else n
    value = F.when(divisor > 0, m2 / divisor)
    return (F.sqrt(value) if root else value).alias(agg.name)


def _merged_spreads(rollup: Rollup, table: DataFrame, keys: list[str], cols: list[Column], spreads: list[AggItem]) -> DataFrame:
    """Spreads of groups of stored moments: ``m2 + n * (mean - group's mean)**2`` summed.

    The groups' means are found first and joined back, so no large squares are
    subtracted from each other: values far from zero lose no digits.
    """
    one = spare_column(table, "group")
    first = moment_columns(rollup.measure("moments", spreads[0].col))[0]
    # without keys all rows are one group; not a literal, so that it stays an equi-join
    table = table.withColumn(one, F.coalesce(F.col(first) * 0, F.lit(0).cast("long")))
    by = [one, *keys]
    stored = dict.fromkeys(rollup.measure("moments", a.col) for a in spreads)
    totals, squares = [], []
    for name in stored:
        n, mean, m2 = moment_columns(name)
        weighted = F.sum(F.when(F.col(n) > 0, F.col(n) * F.col(mean)))
        totals += [F.sum(n).alias(f"all_{n}"), (weighted / F.nullif(F.sum(n), F.lit(0))).alias(f"all_{mean}")]
        apart = F.col(mean) - F.col(f"all_{mean}")
        squares.append(F.sum(F.when(F.col(n) > 0, F.col(m2) + F.col(n) * apart * apart)).alias(f"all_{m2}"))
    groups = table.groupBy(*by).agg(*cols, *totals)
    means = groups.select(*[F.col(k).alias(f"of_{k}") for k in by], *[f"all_{moment_columns(n)[1]}" for n in stored])
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in by]
    spread = table.join(means, same).groupBy(*[F.col(f"of_{k}") for k in by]).agg(*squares)
    rows = groups.join(spread, same)
    names = [a.name for a in spreads]
    out = rows.withColumns(dict(zip(names, (_spread(rollup, a, "all_") for a in spreads))))
    return out.drop(one, *spread.columns, *[f"all_{c}" for n in stored for c in moment_columns(n)])


def _merged_distinct(rollup: Rollup, table: DataFrame, keys: list[str], aggs: list[AggItem]) -> DataFrame:
    """Distinct counts: bitmaps of one bucket are united, then their bits counted."""
    bits = rollup.measures[0][0]
    united = table.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(bits).alias(bits))
    count = F.coalesce(F.sum(F.bitmap_count(bits)), F.lit(0).cast("long"))
    return united.groupBy(*keys).agg(*[count.alias(a.name) for a in aggs])


def spare_column(df: DataFrame, base: str) -> str:
    while base in df.columns:
        base = "_" + base
    return base


#: Buckets of values per power of two: a bucket is a sixteenth of its lower end wide, at most.
STEPS = 16


def value_bucket(x: Column) -> Column:
    """A bucket's number, ascending with the values; 0 holds zero alone, and nulls and NaN have none.

    The exponent of two is found by a logarithm and put right by comparisons, so
    the bounds are exact on every machine (for values of 2**-1000 or more).
    """
    size = F.abs(x.cast("double"))
    guess = F.floor(F.log2(size)).cast("double")
    e = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    step = F.floor((size / F.pow(F.lit(2.0), e) - 1) * STEPS)
    number = (e * STEPS + step).cast("long") + F.lit(1100 * STEPS).cast("long")
    return (
        F.when(x.isNull() | F.isnan(x.cast("double")), None)
        .when(size == 0, F.lit(0).cast("long"))
        .when(x > 0, number)
        .otherwise(-number)
    )


def bucket_bounds(bucket: Column) -> tuple[Column, Column]:
    """The smallest and the largest magnitude-ordered bounds ``[low, high)`` of a bucket (``(low, high]`` below zero)."""
    place = F.abs(bucket) - F.lit(1100 * STEPS)
    e = F.floor(place / STEPS)
    near = F.pow(F.lit(2.0), e) * (1 + (place - e * STEPS) / F.lit(float(STEPS)))
    far = F.pow(F.lit(2.0), e) * (1 + (place - e * STEPS + 1) / F.lit(float(STEPS)))
    zero = F.lit(0.0)
    low = F.when(bucket == 0, zero).when(bucket > 0, near).otherwise(-far)
    high = F.when(bucket == 0, zero).when(bucket > 0, far).otherwise(-near)
    return low, high


def rollup_quantile(rollup: Rollup, table: DataFrame, q: float, keys: Iterable[str] = (), where: Iterable = ()) -> DataFrame:
    """Bounds of a quantile from a ``histogram`` summary table, per group.

    ``n`` values; the quantile is the value of rank ``ceil(q * n)`` (1 is the
    smallest).  It lies between ``low`` and ``high``, which are a sixteenth of
    the lower one apart at most, and the bucket holds the ranks ``first_rank`` to
    ``last_rank``.  Counts of buckets add up, so the bounds are those of the
    events themselves, whatever the grain.  Groups without values have no row.
    """
    stored, func, _ = rollup.measures[0]
    if func != "histogram":
        raise NotCovered(f"{rollup.name} has no histogram")
    keys = list(keys)
    remaining = check_coverage(rollup, spec(select=keys or [rollup.dims[0]], where=list(where), group_by=keys or [rollup.dims[0]]))
    counts = apply_filters(table, remaining).where(F.col(BUCKET).isNotNull()).groupBy(*keys, BUCKET).agg(F.sum(stored).alias("c"))
    # a group has one row per bucket: bounded by the range of doubles, some ten thousands at most
    over = Window.partitionBy(*keys) if keys else Window.partitionBy()
    upto = F.sum("c").over(over.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumns({"last_rank": upto, "n": F.sum("c").over(over)}).withColumn("first_rank", F.col("last_rank") - F.col("c") + 1)
    rank = F.greatest(F.ceil(F.lit(float(q)) * F.col("n")), F.lit(1).cast("long"))
    low, high = bucket_bounds(F.col(BUCKET))
    return ranked.withColumn("rank", rank).where("rank BETWEEN first_rank AND last_rank").select(
        *keys, "n", "rank", "first_rank", "last_rank", low.alias("low"), high.alias("high")
    )


def check_coverage(rollup: Rollup, s: Spec) -> list[Mapping]:
    """Raise NotCovered unless ``rollup`` answers ``s``; return leftover filters."""
    remaining = [dict(w) for w in s.where]
    for fixed in rollup.where:
        if dict(fixed) not in remaining:
            raise NotCovered(f"{rollup.name} only holds rows with {fixed}")
        remaining.remove(dict(fixed))
    for cond in remaining:
        if cond.get("col") not in rollup.dims:
            raise NotCovered(f"{rollup.name} cannot filter on {cond.get('col')!r}")
    for k in s.group_by:
        if k not in rollup.dims:
            raise NotCovered(f"{rollup.name} cannot group by {k!r}")
    for n in s.names:
        if n == "*" or n not in s.group_by:
            raise NotCovered(f"{rollup.name} cannot project {n!r} without grouping by it")
    if not s.aggregating:
        raise NotCovered("a plain projection needs the events")
    out_names = output_names(s, [])
    for agg in s.aggregates:
        _check_derivable(rollup, agg)
    for o in s.order_by:
        key = _order_key(s, o, out_names)
        if isinstance(key, AggItem):
            _check_derivable(rollup, key)
        elif key not in out_names and key not in s.group_by:
            raise NotCovered(f"{rollup.name} cannot order by {key!r}")
    return remaining


def covers(rollup: Rollup, **clauses) -> bool:
    try:
        check_coverage(rollup, spec(**clauses))
        return True
    except NotCovered:
        return False


def rollup_report(
    rollup: Rollup,
    table: DataFrame,
    select=None,
    where=None,
    group_by=None,
    order_by=None,
    limit=None,
    *,
    names: str = "plain",
) -> DataFrame:
    """Answer a report from a rollup table, or raise NotCovered."""
    s = spec(select, where, group_by, order_by, limit)
    remaining = check_coverage(rollup, s)
    out_names = output_names(s, [])
    filtered = apply_filters(table, remaining)
    keys = list(s.group_by)

    aggs = list(dict.fromkeys(s.aggregates))
    hidden: list[str] = []
    for o in s.order_by:
        key = _order_key(s, o, out_names)
        if isinstance(key, AggItem):
            if key not in aggs:
                aggs.append(key)
                hidden.append(key.name)
        elif key not in out_names:
            if key not in keys:
                raise NotCovered(f"cannot order by {key!r}")
            hidden.append(key)

    spreads = [a for a in aggs if a.func in _SPREADS]
    full_grain = set(keys) == set(rollup.dims) and not rollup.bucketed
    cols = [_derive(rollup, a, regroup=not full_grain) for a in aggs if a not in spreads and a.func != "count_distinct"]
    if full_grain:
        result = filtered.select(*keys, *cols, *[_spread(rollup, a) for a in spreads])
    elif spreads:
        result = _merged_spreads(rollup, filtered, keys, cols, spreads)
    elif rollup.bucketed and aggs:
        result = _merged_distinct(rollup, filtered, keys, aggs)
    elif not cols:
        result = filtered.select(*keys).distinct()
    elif keys:
        result = filtered.groupBy(*keys).agg(*cols)
    else:
        result = filtered.agg(*cols)
    return named(finish(result.select(*out_names, *hidden), s, out_names, hidden, unique_keys=keys), s, names)
