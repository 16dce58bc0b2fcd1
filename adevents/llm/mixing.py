"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are counted once and written without the texts.  Every source's target
follows from its weight by water-filling (targets stop at ``max_epochs`` times
the source's size and the excess goes to the others by weight).  Whole passes
over a source come first; the rest of its budget is fitted on the histogram of
exact lengths: every length gives the same share of its documents, then seeded
single documents are added until the remainder is small, and a bounded-knapsack
dynamic programme (a bit set of reachable sums, counts split in binary) finds
the lengths that fill the remainder exactly or as nearly as any choice from
below.  Documents of a length are then chosen by their seeded hash.

No task holds the documents of a source: the histogram has one row per source
and length, and the seeded order inside a (source, length) is built over 256
hash buckets, whose counts give each bucket its start.

Cases: a null text has size 0 and is never repeated, null sources are one
source that sorts last, repeated rows are rows of their own, ties in the hash
fall to equal rows, an empty table gives no rows, further columns are kept by
:func:`mix_documents` and ignored by the digest.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adevents.llm.common import as_table, n_words_of, saved, spare_name, text_or_empty, with_row_id

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
BUCKETS = 256
DP_BUDGET = 65536


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source_key, source, source_size, target``, one row per source.

    Sorted by cap over weight, the sources that reach their cap come first; a
    running sum tells where that ends (the windows see one row per source).
    """
    per_source = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    ranked = per_source.withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"),
        ),
    ).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ranked.withColumns(
        {
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
            "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weights_left": F.sum("weight").over(after),
        }
    ).withColumn("full", F.col("cap") * F.col("weights_left") <= F.col("weight") * (F.col("budget") - F.col("caps_before")))
    full_caps = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weights = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    return level.select(
        "source_key",
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap"))
        .otherwise(F.col("weight") * F.try_divide(F.col("budget") - full_caps, open_weights))
        .alias("target"),
    )


def fill(lengths: list[int], counts: list[int], budget: int, dp_budget: int = DP_BUDGET) -> list[int]:
    """How many of each length to take so that the sum comes nearest to ``budget`` from below.

    ``lengths`` are distinct positive numbers in the order in which ties are
    settled; at most ``counts[i]`` of ``lengths[i]`` are taken.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    taken = [c * budget // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken))
    for i, n in enumerate(lengths):  # the shares' rounding leaves less than one document of each length
        if left <= dp_budget:
            break
        if taken[i] < counts[i] and n <= left:
            taken[i] += 1
            left -= n
    if not left:
        return taken
    # Items of the knapsack: powers of two of a length's remaining count.
    mask = (1 << (left + 1)) - 1
    reach, items, history = 1, [], []
    for i, n in enumerate(lengths):
        spare, step = min(counts[i] - taken[i], left // n), 1
        while spare > 0 and not reach >> left & 1:
            k = min(step, spare)
            grown = (reach | reach << (n * k)) & mask
            if grown != reach:
                items.append((i, k))
                history.append(reach)
                reach = grown
            spare, step = spare - k, step * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for (i, k), reachable in zip(reversed(items), reversed(history)):
        if not reachable >> at & 1:
            taken[i] += k
            at -= lengths[i] * k
    return taken


def _fit(seed: int, dp_budget: int):
    def one_source(hist: pd.DataFrame) -> pd.DataFrame:
        # a seeded order of the lengths, so that no length is favoured
        order = ((hist["size"] * 2654435761 + seed * 40503) % (1 << 32)).sort_values(kind="stable").index
        hist = hist.loc[order]
        budget = int(hist["rest"].iloc[0])
        take = fill([int(x) for x in hist["size"]], [int(x) for x in hist["docs"]], budget, dp_budget)
        return pd.DataFrame({"source_key": hist["source_key"], "size": hist["size"], "take": take})

    return one_source


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _sizes(rows: DataFrame, seed: int, *ids: Column) -> DataFrame:
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), text_or_empty())
    return rows.select(
        *ids,
        _source_key(F.col("source")).alias("source_key"),
        F.col("source"),
        n_words_of(text_or_empty()).alias("size"),
        draw.alias("draw"),
    )


def plan_mix(sizes: DataFrame, seed: int = SEED, dp_budget: int = DP_BUDGET, **mix) -> DataFrame:
    """``sizes`` plus ``source_size``, ``target`` and ``copies`` of every row.

    ``sizes`` is on storage: ``source_key, source, size, draw`` and id columns.
    """
    sizes = sizes.withColumn("bucket", F.pmod(F.shiftright("draw", 40), F.lit(BUCKETS)).cast("int"))
    goal = targets(sizes, **mix).drop("source").withColumn("quota", F.round("target").cast("long"))
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("quota div greatest(source_size, 1)")).otherwise(0))
    goal = saved(goal.withColumn("rest", F.col("quota") - F.col("whole") * F.col("source_size")), "targets")
    by_bucket = saved(sizes.groupBy("source_key", "size", "bucket").agg(F.count("*").alias("docs")), "lengths")
    take = (
        by_bucket.where("size > 0")
        .groupBy("source_key", "size")
        .agg(F.sum("docs").alias("docs"))
        .join(goal.where("rest > 0").select("source_key", "rest"), "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit(seed, dp_budget), "source_key string, size long, take long")
    )
    earlier = Window.partitionBy("source_key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (  # how many of a bucket's first documents are taken
        by_bucket.withColumn("skipped", F.coalesce(F.sum("docs").over(earlier), F.lit(0)))
        .join(take, ["source_key", "size"])
        .select("source_key", "size", "bucket", (F.col("take") - F.col("skipped")).alias("first"))
        .where("first > 0")
    )
    nth = F.row_number().over(Window.partitionBy("source_key", "size", "bucket").orderBy("draw"))
    return (
        sizes.withColumn("nth", nth)
        .join(cut, ["source_key", "size", "bucket"], "left")
        .join(goal.select("source_key", "source_size", "target", "whole"), "source_key")
        .withColumn("copies", F.col("whole") + F.when(F.col("nth") <= F.col("first"), 1).otherwise(0))
        .drop("nth", "first", "whole", "bucket")
    )


def mix_digest(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: size, its source's size and target, words taken."""
    sizes = saved(_sizes(docs.select("doc_id", "source", "text"), seed, F.col("doc_id")), "sizes")
    return plan_mix(sizes, seed).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "source",
    )


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` (all columns), each row as often as the mix takes it."""
    docs = as_table(docs)
    key = spare_name(docs, "row_id")
    rows = with_row_id(docs, key)
    sizes = saved(_sizes(rows, seed, F.col(key).alias("row_id")), "sizes")
    copies = plan_mix(sizes, seed).where("copies > 0").select(
        F.col("row_id").alias(key), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    return rows.join(copies.drop("copy"), key).drop(key)
