"""Clustering around integer centroids with an incremental distance matrix.

Vectors become integers, so every inner product of a vector with a centroid is exact. The matrix of these products is kept
beside the vectors in a written table; when centroids move, a product changes by the vector's components times the change of
the centroid, and only components that changed are looked at. The nearest centroid follows from the products alone, as a
vector's own length is the same for all centroids.

A row of the written table is a block of vectors with their products and the block's sums per cluster. A round is one scan
that writes the next table and one that reads its sums; the table of the round before goes once its successor is complete, so
two of them lie in the shared folder at a time. Centroids and sums (clusters x components numbers) are all the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import fresh_path

DIM = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SALT = "3:"
LARGEST = 1 << 27  # of an integer component: squared distances of 64 components then fit 63 bits
BLOCK = 1024  # vectors of a row of the written table
_SCHEMA = "ids array<long>, v binary, dots binary, sums array<long>"


def kept(vectors: DataFrame, dim: int = DIM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v as doubles) of rows whose vector has `dim` components, none of them null or not finite."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") == dim) & finite)


def integers(points: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles; a component beyond LARGEST is an error, as results would not fit."""
    whole = np.floor(points * float(scale))
    if whole.size and np.abs(whole).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return whole.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            part = batch.slice(low, BLOCK)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), integers(flat.reshape(-1, dim), scale)


def moved(points: np.ndarray, dots: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The inner products after centroids changed by `change` (clusters x components)."""
    out = dots.copy()
    for cluster, own in enumerate(change):
        at = np.flatnonzero(own)
        if len(at):
            out[:, cluster] += points[:, at] @ own[at]
    return out


def assigned(points: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each point; of equally near centroids the one with the smaller number."""
    rest = (centroids**2).sum(axis=1)[None, :] - 2 * dots
    cluster = rest.argmin(axis=1)
    return cluster, (points**2).sum(axis=1) + rest[np.arange(len(points)), cluster]


def _sums(points: np.ndarray, cluster: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Per cluster: number, components' sums, and the distances' sum in two parts that cannot overflow."""
    out = np.zeros((k, points.shape[1] + 3), np.int64)
    for number in np.unique(cluster).tolist():
        own = cluster == number
        out[number, 0] = own.sum()
        out[number, 1:-2] = points[own].sum(axis=0)
        out[number, -2:] = (distance[own] >> 31).sum(), (distance[own] & 0x7FFFFFFF).sum()
    return out


def _row(ids: pa.Array, points: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    cluster, distance = assigned(points, dots, centroids)
    sums = _sums(points, cluster, distance, len(centroids)).reshape(-1)
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([points.astype("<i4").tobytes()], pa.binary()),
            pa.array([dots.astype("<i8").tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums)),
        ],
        ["ids", "v", "dots", "sums"],
    )


def _unpacked(batches: Iterator[pa.RecordBatch], dim: int, k: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(batch.num_rows):
            points = np.frombuffer(batch.column(1)[at].as_buffer(), "<i4").reshape(-1, dim).astype(np.int64)
            yield batch.column(0)[at].values, points, np.frombuffer(batch.column(2)[at].as_buffer(), "<i8").reshape(-1, k)


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, "centroids")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _drop(spark: SparkSession, path: str) -> None:
    """Removes a table of an earlier round that this operator wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _totals(table: DataFrame, k: int, width: int) -> np.ndarray:
    """The blocks' sums added up, as Python numbers (clusters x width)."""
    parts = table.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = np.zeros(k * width, object)
    for r in parts.collect():
        out[r["at"]] = int(r["x"])
    return out.reshape(k, width)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Each kept vector's cluster after `rounds` rounds: (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid).

    Vectors that are null, hold null or not finite numbers or have another number of components take no part; components
    become floor(scale * x), and beyond LARGEST they are an error. The centroids start as the vectors with the smallest
    SHA-256 of the salt and the id; rows without an id start one only where there are too few others, rows that repeat an
    id start in the order of their components. Fewer vectors than `clusters` give as many centroids; none give no row.
    Every row is a vector of its own, whatever ids it shares. An empty centroid stays where it is. Other columns are ignored.
    `vectors` is read twice, for the first centroids and for the first table.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, dim)
    first = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(clusters).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = integers(np.array([r["v"] for r in first], np.float64), scale)
    k = len(centroids)

    def start(batches: Iterator[pa.RecordBatch], centroids=centroids) -> Iterator[pa.RecordBatch]:
        for ids, points in _blocks(batches, dim, scale):
            yield _row(ids, points, moved(points, np.zeros((len(points), k), np.int64), centroids), centroids)

    table, path = _written(rows.mapInArrow(start, _SCHEMA))
    for _ in range(rounds):
        totals = _totals(table, k, dim + 3)
        means = [[s // int(own[0]) for s in own[1:-2]] if own[0] else old for own, old in zip(totals, centroids.tolist(), strict=True)]
        after = np.array(means, np.int64)
        change = after - centroids
        if not change.any():  # nothing moves any more: all further rounds are like this one
            break
        centroids = after

        def step(batches: Iterator[pa.RecordBatch], change=change, centroids=centroids) -> Iterator[pa.RecordBatch]:
            for ids, points, dots in _unpacked(batches, dim, k):
                yield _row(ids, points, moved(points, dots, change), centroids)

        before = path
        table, path = _written(table.mapInArrow(step, _SCHEMA))
        _drop(spark, before)
    inertia = [(int(own[-2]) << 31) + int(own[-1]) for own in _totals(table, k, dim + 3)]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"]
        every = pa.array(centroids.tolist(), pa.list_(pa.int64()))
        for ids, points, dots in _unpacked(batches, dim, k):
            own, distance = assigned(points, dots, centroids)
            columns = [ids, pa.array(own, pa.int32()), pa.array(distance), pa.array(inertia).take(pa.array(own)), pa.array([sum(inertia)] * len(own), pa.int64()), pa.array(digests).take(pa.array(own)), every.take(pa.array(own))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return table.mapInArrow(result, schema)
