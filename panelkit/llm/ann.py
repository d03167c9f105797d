"""Nearest neighbours through randomly rotated one-bit codes.

A vector is centred, normalised and rotated; its code is the signs, its correction scalars are the distance to the centre
and the inner product of the unit vector with its code. From a code and a rotated query follow an estimate of their inner
product and a bound of its error, which holds with a probability that `ERROR_BOUND` sets. Only vectors whose smallest
possible distance is within the best found so far are compared on the original numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import saved

NEAREST = 10
ERROR_BOUND = 3.0  # deviations
QUERY_BYTES = 32 << 20  # queries go to all tasks in blocks of this size; more queries mean more scans of the index
_SLICE = 128  # queries whose estimates a worker holds at once
_SEED = 11


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of rows with an id and a vector that is not null, empty or zero and whose numbers are all finite."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(_SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float64, copy=False)


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = _matrix(batch.column(0).filter(pa.array(dims == dim)), dim)
                sums[dim] = sums.get(dim, 0.0) + np.append(part.sum(axis=0), len(part))
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], ["dim", "s"])

    parts = rows.select("v", "dim").mapInArrow(run, "dim int, s array<double>").select("dim", F.posexplode("s").alias("at", "x"))
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("dim", "at").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["dim"], np.zeros(r["dim"] + 1))[r["at"]] = r["x"]
    return {dim: s[:-1] / s[-1] for dim, s in out.items()}


def encode(rows: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """The index: every usable row with its packed code and correction scalars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {dim: rotation(dim) for dim in middle}
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                rest = _matrix(own.column(1), dim) - middle[dim]
                length = np.linalg.norm(rest, axis=1)
                turned = rest / np.where(length > 0, length, 1)[:, None] @ turns[dim].T
                code = np.packbits(turned > 0, axis=1)
                inner = np.abs(turned).sum(axis=1) / np.sqrt(dim)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), own.column(2), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(inner)],
                    ["vec_id", "v", "dim", "code", "length", "inner"],
                )

    return rows.mapInArrow(run, "vec_id long, v array<double>, dim int, code binary, length double, inner double")


def _distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in the order of the components."""
    total = np.zeros(len(points))
    for at in range(points.shape[1]):
        total += (points[:, at] - query[at]) ** 2
    return np.sqrt(total)


class _Best:
    """The nearest rows seen so far of each query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, middle: np.ndarray, nearest: int):
        self.ids, self.vectors, self.nearest = ids, vectors, nearest
        rest = vectors - middle
        self.length = np.linalg.norm(rest, axis=1)
        self.turned = (rest / np.where(self.length > 0, self.length, 1)[:, None]) @ rotation(vectors.shape[1]).T
        self.found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]

    def see(self, vec_ids: np.ndarray, points: np.ndarray, code: np.ndarray, length: np.ndarray, inner: np.ndarray) -> None:
        dim = points.shape[1]
        signs = np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1
        safe = np.where(inner > 0, inner, 1)  # a row at the centre has length 0, so its estimate has no weight
        error = ERROR_BOUND * np.sqrt(np.maximum(1 - safe**2, 0)) / safe / np.sqrt(max(dim - 1, 1))
        for start in range(0, len(self.ids), _SLICE):
            part = slice(start, start + _SLICE)
            estimate = (self.turned[part].astype(np.float32) @ signs.T) / np.sqrt(dim) / safe
            own = self.length[part][:, None]
            middle = length**2 + own**2 - 2 * own * length * estimate
            lowest = middle - 2 * own * length * error - 1e-6 * (length**2 + own**2)
            for row, number in enumerate(range(start, min(start + _SLICE, len(self.ids)))):
                self._merge(number, lowest[row], middle[row], vec_ids, points)

    def _merge(self, number: int, lowest: np.ndarray, middle: np.ndarray, vec_ids: np.ndarray, points: np.ndarray) -> None:
        distance, ids = self.found[number]
        k, other = self.nearest, vec_ids != self.ids[number]
        if len(distance) < k:  # the rows of the best estimates give a first limit
            first = np.flatnonzero(other)
            if len(first) > 2 * k:
                first = first[np.argpartition(middle[first], 2 * k)[: 2 * k]]
            limits = np.sort(np.concatenate([distance, _distances(points[first], self.vectors[number])]))
            limit = limits[k - 1] if len(limits) >= k else np.inf
        else:
            limit = distance[-1]
        chosen = np.flatnonzero((lowest <= limit * limit * (1 + 1e-9)) & other)
        if not len(chosen):
            return
        distance = np.concatenate([distance, _distances(points[chosen], self.vectors[number])])
        ids = np.concatenate([ids, vec_ids[chosen]])
        order = np.lexsort((ids, distance))[:k]
        self.found[number] = distance[order], ids[order]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of `vectors` to each query, itself (its id) left out.

    Both tables have vec_id and embedding. Vectors that are null, empty or zero, or hold null or infinite numbers, take no
    part, nor do rows without an id. Only vectors of one dimension are compared. Rows with equal vectors are ranked by id;
    rows that repeat an id are candidates of their own, while of queries that repeat an id the smallest vector is asked.
    Fewer candidates than k give fewer rows; an empty table gives none; other columns are ignored.
    """
    rows = usable(vectors)
    middle = centres(rows)
    asked = usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = saved(asked.withColumn("dim", F.size("v")))
    schema = "query_id long, vec_id long, score double"
    if not middle:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    index = saved(encode(rows, middle))
    total = asked.agg(F.sum(8 * F.col("dim"))).first()[0] or 0
    parts = int(total // QUERY_BYTES) + 1
    out = None
    for part in range(parts):
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).collect()
        by_dim = {dim: [r for r in block if r["dim"] == dim] for dim in {r["dim"] for r in block} & set(middle)}
        asked_by_dim = {dim: (np.array([r["vec_id"] for r in found]), np.array([r["v"] for r in found], np.float64)) for dim, found in by_dim.items()}

        def run(batches: Iterator[pa.RecordBatch], asked_by_dim=asked_by_dim) -> Iterator[pa.RecordBatch]:
            best = {dim: _Best(ids, v, middle[dim], k) for dim, (ids, v) in asked_by_dim.items()}
            for batch in batches:
                dims = batch.column(2).to_numpy()
                for dim in np.unique(dims).tolist():
                    if dim in best:
                        own = batch.filter(pa.array(dims == dim))
                        code = np.frombuffer(b"".join(own.column(3).to_pylist()), np.uint8).reshape(-1, (dim + 7) // 8)
                        best[dim].see(own.column(0).to_numpy(), _matrix(own.column(1), dim), code, own.column(4).to_numpy(), own.column(5).to_numpy())
            for one in best.values():
                for number, (distance, ids) in enumerate(one.found):
                    if len(ids):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), one.ids[number])), pa.array(ids), pa.array(distance)], ["query_id", "vec_id", "score"])

        found = index.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
