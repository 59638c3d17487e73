"""Clustering of integer vectors around centroids, with partial distances.

Each of ``rounds`` rounds assigns every vector to its nearest centroid and moves each centroid to the floor of its vectors' mean; then vectors are
assigned once more.  All numbers are whole.  A vector's distance to a centroid is added up over ``STEP`` dimensions at a time, those of
largest variance first; a centroid is abandoned once the sum is strictly above the vector's best distance so far, and those that are never
abandoned are summed over all dimensions.  So the nearest centroid, and of equally near ones the smallest number, are exact.

Vectors lie in a table in the shared folder and are read once a round.  Tasks add up their own vectors; what is shuffled
and what reaches the driver are sums for each task, centroid and dimension, whatever the number of vectors, or of equal ones.

Defined cases: vectors that are null, of another size, or hold a null or non-finite component take no part; nor do those with a component of
2^21 or more, whose distances need not fit in 64 bits; repeated rows count as often as they stand; a null vec_id gives no starting centroid before
all others; fewer vectors than centroids give fewer centroids; equal hashes start in the order of their vectors; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, bounded_batches, materialize

SIZE, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
#: Dimensions added to the sums at a time.
STEP = 8
#: Largest absolute component; twice SCALE times it, squared and summed over 64 dimensions, fits in 64 bits.
LARGEST = float(1 << 21)
#: Rows handed to one numpy step.
ROWS = 4096


def whole_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v, the floors of the scaled components, of the vectors that take part."""
    x = vectors[vector_col].cast("array<double>")
    usable = (F.size(x) == size) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    return vectors.where(usable).select(vectors[id_col].cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def starts(table: DataFrame, centroids: int, seed: int, size: int = SIZE) -> np.ndarray:
    """The vectors of least hash, in the order of their hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = table.orderBy(order.asc_nulls_last(), "v").limit(centroids).select("v").collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), size)


def nearest(v: np.ndarray, centroids: np.ndarray, order: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to each row's nearest centroid, by partial distances over ``order``."""
    v, centroids = v[:, order], centroids[:, order]
    ahead = ((v[:, None, :step] - centroids[None, :, :step]) ** 2).sum(axis=2)
    best = ahead.argmin(axis=1)  # probably near: its whole distance is the first to beat
    distance = ((v - centroids[best]) ** 2).sum(axis=1)
    for k in range(len(centroids)):
        rows, sums = np.arange(len(v)), ahead[:, k]
        for at in range(step, v.shape[1] + step, step):
            stays = sums <= distance[rows]
            rows, sums = rows[stays], sums[stays]
            if not len(rows) or at >= v.shape[1]:
                break
            sums = sums + ((v[rows, at : at + step] - centroids[k, at : at + step]) ** 2).sum(axis=1)
        nearer = (sums < distance[rows]) | ((sums == distance[rows]) & (k < best[rows]))
        best[rows[nearer]], distance[rows[nearer]] = k, sums[nearer]
    return best, distance


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The first column and the vectors of each batch, some thousand rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _sums(table: DataFrame, group_sums, size: int) -> dict[int, tuple[int, list[int]]]:
    """Rows and sums by dimension of each group; ``group_sums`` gives a vector's group and what is added up, on each matrix."""

    def add(batches):
        counts, sums = {}, {}
        for _, v in _matrices(batches):
            groups, values = group_sums(v)
            for g in np.unique(groups).tolist():
                own = groups == g
                counts[g] = counts.get(g, 0) + int(own.sum())
                sums[g] = sums.get(g, 0) + values[own].sum(axis=0)
        keys = sorted(counts)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([counts[g] for g in keys], pa.int64()), pa.array([sums[g].tolist() for g in keys], pa.list_(pa.int64()))], names=["g", "n", "sums"])

    parts = table.select("vec_id", "v").mapInArrow(add, "g int, n long, sums array<long>")
    wide = F.array(*(F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(size)))
    return {r.g: (r.n, [int(x) for x in r.sums]) for r in parts.groupBy("g").agg(F.sum("n").alias("n"), wide.alias("sums")).collect()}


def by_variance(table: DataFrame, size: int) -> np.ndarray:
    """Dimensions by falling variance."""
    n, sums = _sums(table, lambda v: (np.zeros(len(v), np.int32), v), size).get(0, (0, [0] * size))
    middle = np.array([s // n if n else 0 for s in sums], np.int64)
    _, squares = _sums(table, lambda v: (np.zeros(len(v), np.int32), np.minimum(np.abs(v - middle), 1 << 14) ** 2), size).get(0, (0, [0] * size))
    return np.argsort(-np.array(squares, dtype=object), kind="stable").astype(np.int64)


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 1, size: int = SIZE, scale: int = SCALE, **columns) -> tuple[DataFrame, list[list[int]]]:
    """A table of vec_id, cluster and distance, and the final centroids."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    with Tables(spark) as tables:
        table = tables.write(whole_vectors(vectors, size, scale, **columns), "whole-vectors")
        centres = starts(table, centroids, seed, size)
        order = by_variance(table, size)
        for _ in range(rounds if len(centres) else 0):
            for k, (n, sums) in _sums(table, lambda v, c=centres: (nearest(v, c, order)[0], v), size).items():
                centres[k] = [s // n for s in sums]

        def assign(batches):
            for ids, v in _matrices(batches):
                k, distance = nearest(v, centres, order)
                yield pa.RecordBatch.from_arrays([ids, pa.array(k, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

        return materialize(table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters"), centres.tolist()


def cluster_rows(vectors: DataFrame, **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia and a digest of the cluster's centroid."""
    assigned, centres = cluster(vectors, **options)
    spark = vectors.sparkSession
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row for each centroid
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    known = [(k, sums[k], sum(sums.values()), shas[k]) for k in sorted(sums)]
    per_cluster = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
