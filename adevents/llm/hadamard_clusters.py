"""Centroid clustering with an exact progressive search in the Walsh-Hadamard domain.

The transform of integer vectors is exact in integers, and keeps distances:
the squared distance of two vectors is 1/64 of the sum of the squared
differences of their 64 coefficients.  The coefficients, ordered from coarse
(few sign changes along the vector) to fine, are looked at level by level: the
squared differences so far are a lower bound of the whole, which only grows.
The centroid that is ahead after the first levels is finished at once, and
every centroid whose bound is above that distance is strictly worse and
eliminated; the others go on to the next level, and what is left after the last
has all 64 coefficients and so its exact distance.  Ties fall to the smaller
number.  Sums stay below the size to which doubles (or else longs) are exact.

Vectors are turned into integers (``floor(SCALE * x)``) as they are read.  A
round is one scan: tasks search their vectors against the broadcast centroids
(a fixed number of 64 integers) and send one row of sums per cluster, which
Spark adds up; so a cluster that holds a third of all vectors, or all copies of
one vector, is one row per task.  Only the centroids pass through the driver.

Cases: vectors that are null, have other than 64 components, or a null, NaN or
infinite one are left out; repeated rows are vectors of their own; a null
``vec_id`` is hashed as an empty text; ties between hashes of repeated ids fall
to the smaller vector; fewer than ``k`` vectors give fewer centroids; an empty
table gives no rows; further columns are ignored.  Integers beyond 2**24 in
size are computed with Python's integers; a distance or inertia beyond a long
raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adevents.llm.common import saved

SIZE = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Ends of the levels that are taken for all centroids at once, before there is a bound.
DENSE = (1, 2, 4, 8, 16, 32)
#: Ends of the levels after which the centroids above the bound are eliminated.
FINE = (48, 64)
#: Integers up to which sums of squared coefficients are exact in a double, or fit a long.
_DOUBLE, _LONG = 1 << 16, 1 << 24
_ASSIGNED = "vec_id long, cluster int, distance long"


def _sequency_order() -> np.ndarray:
    """The transform's rows by their number of sign changes."""
    rows = transform(np.eye(SIZE, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The (unnormalised) Walsh-Hadamard transform of each row; exact for integers."""
    n, half = len(x), 1
    while half < SIZE:
        pairs = x.reshape(n, SIZE // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, SIZE)
        half *= 2
    return x


_ORDER = _sequency_order()


_ROWS = transform(np.eye(SIZE))[:, _ORDER]


def coefficients(x: np.ndarray) -> np.ndarray:
    """Coefficients from coarse to fine."""
    return x @ _ROWS if x.dtype == np.float64 else transform(x)[:, _ORDER]


def search(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number and the squared distance of each vector's nearest centroid (rows of 64 integers)."""
    n = len(vectors)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    largest = max(np.abs(vectors).max(), np.abs(centroids).max())
    # Sums of 64 squares of coefficients are exact in a double below 2**53, in a long below 2**63.
    kind = np.float64 if largest <= _DOUBLE else np.int64 if largest <= _LONG else object
    v, c = coefficients(vectors.astype(kind)), coefficients(centroids.astype(kind))
    so_far, begin = np.zeros((n, len(c)), kind), 0
    for end in DENSE:
        part, other = v[:, begin:end], c[:, begin:end]
        so_far = so_far + ((part * part).sum(axis=1)[:, None] + (other * other).sum(axis=1) - 2 * (part @ other.T))
        begin = end
    # Finish the centroid that is ahead; what is above that already is strictly worse.
    ahead = so_far.argmin(axis=1)
    rest = v[:, begin:] - c[ahead, begin:]
    best = so_far[np.arange(n), ahead] + (rest * rest).sum(axis=1)
    owner, number = np.nonzero(so_far <= best[:, None])
    left = so_far[owner, number]
    for end in FINE:
        difference = v[owner, begin:end] - c[number, begin:end]
        left = left + (difference * difference).sum(axis=1)
        begin = end
        stays = np.flatnonzero(left <= best[owner])
        owner, number, left = owner[stays], number[stays], left[stays]
    # All that is left has its whole distance; owners and numbers ascend, so the first of equals is the smallest.
    distance = np.minimum.reduceat(left, np.searchsorted(owner, np.arange(n)))
    nearest = np.flatnonzero(left == distance[owner])
    nearest = nearest[np.searchsorted(owner[nearest], np.arange(n))]
    if kind is object:
        distance = np.array([int(d) // SIZE for d in distance], np.int64)  # raises where it doesn't fit
    else:
        distance = distance.astype(np.int64) // SIZE
    return number[nearest], distance


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of a column's vectors are kept, and those as rows of integers."""
    lists = column.cast(pa.large_list(pa.float64()))
    size = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    chosen = np.flatnonzero(size == SIZE)
    flat = pc.list_flatten(lists.take(pa.array(chosen)))
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, SIZE)
    finite = np.isfinite(x).all(axis=1)
    chosen, x = chosen[finite], np.floor(SCALE * x[finite])
    if x.size and np.abs(x).max() >= 1 << 62:
        return chosen, np.array([[int(e) if np.isfinite(e) else int(SCALE) * int(e / SCALE) for e in row] for row in x], object)
    return chosen, x.astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, rows: int = 4096):
    """``(vec_ids, vectors, clusters, distances)`` of the kept vectors."""
    for whole in batches:
        for a in range(0, whole.num_rows, rows):
            batch = whole.slice(a, rows)
            chosen, x = integers(batch.column("embedding"))
            if len(chosen):
                yield batch.column("vec_id").take(pa.array(chosen)), x, *search(x, centroids)


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The ``k`` kept vectors with the smallest hashes of their ids, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.where(_kept(F.col("embedding"))).select(digest.alias("digest"), "embedding")
    first = rows.orderBy("digest", "embedding").limit(k).select("embedding").toArrow()  # k rows
    return integers(first.column("embedding").combine_chunks())[1] if first.num_rows else np.zeros((0, SIZE), np.int64)


def _kept(x: Column) -> Column:
    whole = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.coalesce((F.size(x) == SIZE) & whole, F.lit(False))


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty cluster's floor(sum / count), componentwise; the others' centroids."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(centroids)
    names = [f"s{i}" for i in range(SIZE)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value)
        count, sums = np.zeros(k, np.int64), np.zeros((k, SIZE), object)
        for _, x, cluster, _ in _batches(batches, shared.value):
            count += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(cluster[order]) > 0])
            values = x if np.abs(x).max() <= _LONG else x.astype(object)
            sums[cluster[order][edges]] += np.add.reduceat(values[order], edges, axis=0).astype(object)
        used = np.flatnonzero(count)
        columns = [pa.array(used, pa.int32()), pa.array(count[used], pa.int64())]
        columns += [pa.array([Decimal(int(s)) for s in sums[used, i]], pa.decimal128(38, 0)) for i in range(SIZE)]
        yield pa.record_batch(columns, names=["cluster", "n", *names])

    schema = "cluster int, n long, " + ", ".join(f"{c} decimal(38,0)" for c in names)
    sums = (
        vectors.select("vec_id", "embedding")
        .mapInArrow(add, schema)
        .groupBy("cluster")
        .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
    )
    out = centroids.copy()
    for r in sums.collect():  # at most one row per centroid
        means = [int(r[c]) // r["n"] for c in names]
        if max(map(abs, means)) >= 1 << 62 and out.dtype != object:
            out = out.astype(object)
        out[r["cluster"]] = means
    return out


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after the given rounds, ``(k, 64)`` integers."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every kept vector (``vec_id, embedding``)."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(shared.value):
            for ids, _, cluster, distance in _batches(batches, shared.value):
                yield pa.record_batch(
                    [ids.cast(pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return vectors.select("vec_id", "embedding").mapInArrow(nearest, _ASSIGNED)


def cluster_digest(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: cluster, distance, inertias and its centroid's sha256."""
    centroids = fit(vectors, k, rounds)
    spark = vectors.sparkSession
    placed = saved(assign(vectors, centroids), "clusters")
    names = [(i, hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()) for i, c in enumerate(centroids)]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    per_cluster = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"), F.count("*").alias("cluster_size"))
    inertia = F.sum("cluster_inertia").over(Window.partitionBy()).alias("inertia")  # over one row per centroid
    facts = per_cluster.join(named, "cluster").select("*", inertia)
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size"
    )
