"""Centroid clustering of whole-number vectors, with Orchard search for the nearest centroid.

A vector is kept if it has exactly ``dims`` components, none null, NaN or infinite; a component
x becomes floor(``scale`` * x).  All further arithmetic is exact: distances are squared, in 64-bit
integers, and a new centroid is the floor of an exact mean, so results do not depend on how rows
are dealt out or on which tasks run twice.

Search.  Each centroid has a list of the other ones, nearest first.  A vector starts at some
centroid and reads its list; a centroid on it that is closer (or as close, with a smaller number)
becomes the current one, and reading starts anew on its list.  Centroids met before are marked and
not measured again.  By the triangle inequality a centroid that is further from the current one
than twice the vector is cannot be closer, so the list is left there: strictly beyond twice,
since at exactly twice it may be as close and have a smaller number.  In squares, strictly beyond
four times.  All vectors of a batch take their steps together.

A round reads the vectors once and moves one row of sums for each task and centroid.  What the
driver holds is the centroids, their lists and one sum for each component: k * dims numbers.

Seeds are the k kept vectors with the smallest hash of their id, equal hashes by their
components; fewer kept vectors give fewer centroids.

Defined results: repeated rows are vectors of their own; a null id hashes like an empty one; a
centroid without vectors stays where it is; no kept vectors give no rows.  Whole numbers beyond
``LARGEST`` either way count as that, since squares of larger ones would not fit the distance.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.session import pin

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1
LARGEST = 1 << 27
#: Vectors that search together.
ROWS_AT_ONCE = 1 << 14


def whole_numbers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, numbers)``: which vectors of a list column are kept, and their whole numbers."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros((0, dims), np.int64)
    ends = np.asarray(column.offsets, np.int64)
    rows = np.flatnonzero((np.diff(ends) == dims) & column.is_valid().to_numpy(zero_copy_only=False))
    # Whole lists of one length: their components stand in a row each.
    flat = column.values.take(pa.array((ends[rows][:, None] + np.arange(dims)).ravel()))
    numbers = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # null is NaN
    good = np.isfinite(numbers).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(numbers[good] * scale)
    return rows[good], np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the others, nearest first, and their squared distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, -1)  # first in its own list, and cut off there
    order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and distances measured."""
    count, k = len(vectors), len(centroids)
    lists, apart = neighbours(centroids)

    def measure(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        away = vectors[rows] - centroids[to]
        return np.einsum("ij,ij->i", away, away)

    current, place = np.zeros(count, np.int64), np.zeros(count, np.int64)
    best = measure(np.arange(count), current)
    marked = np.zeros((count, k), bool)
    marked[:, 0] = True
    measured = count
    going = np.arange(count) if k > 1 else np.zeros(0, np.int64)
    while len(going):
        at, on = place[going], current[going]
        going = going[apart[on, at] <= 4 * best[going]]
        met = lists[current[going], place[going]]
        place[going] += 1
        new = ~marked[going, met]
        rows, to = going[new], met[new]
        marked[rows, to] = True
        far = measure(rows, to)
        measured += len(rows)
        closer = (far < best[rows]) | ((far == best[rows]) & (to < current[rows]))
        moved = rows[closer]
        current[moved], best[moved], place[moved] = to[closer], far[closer], 0
        going = going[place[going] < k - 1]
    return current, best, measured


def _parts(batch: pa.RecordBatch, dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The kept rows of a batch with their whole numbers, some at a time."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        rows, numbers = whole_numbers(part.column("_vector"), dims, scale)
        if len(rows):
            yield part.take(pa.array(rows)), numbers


def _seed_rows(k: int, dims: int, scale: int):
    """The k smallest hashes of each batch."""

    def run(batches):
        for batch in batches:
            for part, numbers in _parts(batch, dims, scale):
                keyed = list(zip(part.column("_hash").to_pylist(), map(tuple, numbers.tolist())))
                least = sorted(keyed)[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in least]), pa.array([v for _, v in least], pa.list_(pa.int64()))],
                    ["_hash", "_numbers"],
                )

    return run


def _sums(shared, dims: int, scale: int):
    """One row for each centroid that has vectors in this task: their number and sums."""

    def run(batches):
        centroids = shared.value
        k = len(centroids)
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, numbers in _parts(batch, dims, scale):
                cluster = nearest(numbers, centroids)[0]
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                sums[found] += np.add.reduceat(numbers[order], first, axis=0)
                count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            ["_cluster", "_n", "_sums"],
        )

    return run


def _assign(shared, dims: int, scale: int):
    def run(batches):
        centroids = shared.value
        for batch in batches:
            for part, numbers in _parts(batch, dims, scale):
                cluster, distance, _ = nearest(numbers, centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["_id", "cluster", "distance"],
                )

    return run


def seeds(plain: DataFrame, k: int, dims: int, scale: int, seed: int) -> np.ndarray:
    """The first centroids; ``plain`` has ``_id`` and ``_vector``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    hashed = plain.select(F.sha2(text, 256).alias("_hash"), "_vector")
    least = hashed.mapInArrow(_seed_rows(k, dims, scale), "_hash string, _numbers array<long>")
    rows = least.orderBy("_hash", "_numbers").limit(k).collect()  # k rows
    return np.array([r["_numbers"] for r in rows], np.int64).reshape(len(rows), dims)


def next_centroids(plain: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """One round: the floor of the mean of each centroid's vectors."""
    shared = plain.sparkSession.sparkContext.broadcast(centroids)
    try:
        sums = plain.select("_vector").mapInArrow(
            _sums(shared, dims, scale), "_cluster int, _n long, _sums array<long>"
        )
        # A sum for each centroid and component, and the number of vectors beside the first.
        rows = sums.select(
            "_cluster", "_n", F.posexplode("_sums").alias("_place", "_sum")
        ).groupBy("_cluster", "_place").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")).collect()
    finally:
        shared.unpersist()
    moved = centroids.copy()
    for row in rows:
        moved[row["_cluster"], row["_place"]] = row["_sum"] // row["_n"]
    return moved


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
    k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(assigned, clusters)``: ``vec_id``, ``cluster`` and squared ``distance`` of each kept
    vector; and of each of the at most k centroids ``cluster``, ``centroid`` (its components),
    ``size`` and ``inertia`` (the distances of its vectors, summed)."""
    spark = vectors.sparkSession
    plain = vectors.select(F.col(vec_id).alias("_id"), F.col(vector).alias("_vector"))
    centroids = seeds(plain, k, dims, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(plain, centroids, dims, scale)
    table = [(i, c) for i, c in enumerate(centroids.tolist())]
    found = spark.createDataFrame(table, "cluster int, centroid array<long>")
    kind = T.StructType([
        T.StructField("_id", plain.schema["_id"].dataType),
        T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
    ])
    if not table:
        empty = spark.createDataFrame([], kind)
        assigned = empty.withColumnRenamed("_id", vec_id)
        return assigned, found.withColumns({"size": F.lit(0).cast("long"), "inertia": F.lit(0).cast("long")})
    # The search holds what it needs of a broadcast until the rows are pinned.
    shared = spark.sparkContext.broadcast(centroids)
    assigned = pin(plain.mapInArrow(_assign(shared, dims, scale), kind))
    shared.unpersist()
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("distance").alias("inertia")
    )
    zero = F.lit(0).cast("long")
    clusters = found.join(sums, "cluster", "left").select(
        "cluster", "centroid", F.coalesce("size", zero).alias("size"), F.coalesce("inertia", zero).alias("inertia")
    )
    return assigned.withColumnRenamed("_id", vec_id), clusters


def cluster_digests(assigned: DataFrame, clusters: DataFrame, vec_id: str = "vec_id") -> DataFrame:
    """Each vector with the inertia of its cluster and of all, and a digest of its centroid."""
    rows = clusters.collect()  # at most k
    total = sum(r["inertia"] for r in rows)
    table = [
        (r["cluster"], r["inertia"], total, digest(np.array(r["centroid"], np.int64))) for r in rows
    ]
    named = assigned.sparkSession.createDataFrame(
        table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(named), "cluster").select(
        vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
