"""Hard negatives by angular triangle filtering.

The index holds each vector as integers with its norm and its angles to a few reference directions. Angles obey the triangle
inequality: the angle between an anchor and a row lies between the largest difference of their angles to a reference and the
smallest sum, so its cosine lies in an interval, and times both norms this bounds the integer inner product. Bounds are widened
by more than all rounding before they are compared. Blocks of rows, which lie near each other as the index is sorted by
nearest reference, are bounded first, then single rows; only what overlaps a window that is still open is scored, in integers.

References are directions of a bounded sample; a bad sample costs time, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import saved

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # hundredths of the positive's score between which a negative's lies
REFERENCES = 16
SAMPLE = 4096  # rows (smallest hashes) that the references and the first limits come from
QUERY_BYTES = 32 << 20  # anchors go to all tasks in blocks of this size; more anchors mean more scans of the index
BLOCK = 1024  # rows that are bounded together
SLACK = 4e-6  # radians: stored angles are single precision, off by less than a tenth of this
_SLICE = 256  # anchors whose bounds a worker holds at once
_NEVER = np.iinfo(np.int64).min
_ALWAYS = np.iinfo(np.int64).max
_SEED = 12
_INDEX = "vec_id long, label long, v binary, dim int, norm double, angles binary, cell int, near float"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v, dim) of rows with an id, a label and a vector that is not empty and whose numbers are all finite."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("long").alias("label"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    there = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    return rows.where(there & (F.size("v") > 0) & finite).withColumn("dim", F.size("v"))


def integers(points: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); vectors whose inner products might not fit 62 bits are an error."""
    whole = np.floor(points * float(scale))
    most = float(np.abs(whole).max()) if whole.size else 0.0
    if most > 2**31 - 1 or most * most * points.shape[1] >= 2.0**62:
        raise ValueError("vectors are too long for integer inner products")
    return whole.astype(np.int64)


def directions(points: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors that the sample's vectors lie around (spherical k-means); random ones where the sample has none."""
    draw = np.random.default_rng(_SEED + dim)
    length = np.linalg.norm(points, axis=1) if len(points) else np.zeros(0)
    unit = points[length > 0] / length[length > 0, None]
    if len(unit) < REFERENCES:
        fill = draw.standard_normal((REFERENCES - len(unit), dim))
        return np.concatenate([unit.reshape(-1, dim), fill / np.linalg.norm(fill, axis=1)[:, None]])
    own = unit[draw.choice(len(unit), REFERENCES, replace=False)]
    for _ in range(5):
        nearest = (unit @ own.T).argmax(axis=1)
        sums = np.zeros((REFERENCES, dim))
        np.add.at(sums, nearest, unit)
        size = np.linalg.norm(sums, axis=1)
        own = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], own)
    return own


def angles_to(points: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """(rows, references); a zero vector has some angle, which its norm makes harmless."""
    return np.arccos(np.clip(points @ references.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))


def index(rows: DataFrame, references: dict[int, np.ndarray], scale: int) -> DataFrame:
    """Every usable row with its norm and angles, sorted so that a task's rows lie around few references."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(references)
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                points = integers(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale)
                if dim not in known:
                    known[dim] = directions(np.zeros((0, dim)), dim)
                norm = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))
                angles = angles_to(points.astype(np.float64), norm, known[dim])
                cell = angles.argmin(axis=1)
                columns = [
                    part.column(0), part.column(1), pa.array([p.tobytes() for p in points.astype("<i4")], pa.binary()), part.column(3), pa.array(norm),
                    pa.array([a.tobytes() for a in angles.astype("<f4")], pa.binary()), pa.array(cell, pa.int32()), pa.array(angles.min(axis=1).astype(np.float32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "dim", "norm", "angles", "cell", "near"])

    order = ["dim", "cell", "near", "vec_id"]
    return rows.select("vec_id", "label", "v", "dim").mapInArrow(run, _INDEX).repartitionByRange(*order).sortWithinPartitions(*order)


def _bytes(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


class Rows:
    """Index rows of one dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, norm: np.ndarray, angles: np.ndarray):
        self.ids, self.labels, self.points, self.norm, self.angles = ids, labels, points, norm, angles
        self.largest = int(np.abs(points).max()) if points.size else 0

    @classmethod
    def of(cls, part: pa.RecordBatch, dim: int) -> Rows:
        points = _bytes(part.column(2), "<i4", dim).astype(np.int64)
        return cls(part.column(0).to_numpy(), part.column(1).to_numpy(), points, part.column(4).to_numpy(), _bytes(part.column(5), "<f4", REFERENCES).astype(np.float64))

    def part(self, low: int, high: int) -> Rows:
        return Rows(*(x[low:high] for x in (self.ids, self.labels, self.points, self.norm, self.angles)))


def score_bounds(norm: np.ndarray, own: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest possible score for angles from `nearest` to `farthest` and lengths from `small` to `own`, times `norm`."""
    top, bottom = np.cos(np.maximum(nearest - SLACK, 0)), np.cos(np.minimum(farthest + SLACK, np.pi))
    highest = norm * np.where(top >= 0, own, small) * top
    lowest = norm * np.where(bottom >= 0, small, own) * bottom
    loose = 1e-9 * norm * own + 1e-6
    return np.floor(lowest - loose), np.ceil(highest + loose)


class Search:
    """The best rows of each window (an anchor and limits of the score) among the rows seen so far."""

    def __init__(self, anchors: Rows, owner: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, most: int):
        """`owner` (the anchor of each window) ascends; windows hold rows of the anchor's label, or else of other labels."""
        self.anchors, self.owner, self.low, self.high, self.same, self.most = anchors, owner, low, high, same, most
        self.first = np.searchsorted(owner, np.arange(len(anchors.ids)))
        self.count = np.bincount(owner, minlength=len(anchors.ids))
        self.limit = low.copy()  # the lowest score that still matters
        none = np.zeros(0, np.int64)
        self.window, self.ids, self.scores = none, none, none
        self.scored = 0

    def open_limits(self) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor the lowest and highest score that any of its windows still takes."""
        low, high = np.full(len(self.anchors.ids), _ALWAYS), np.full(len(self.anchors.ids), _NEVER)
        np.minimum.at(low, self.owner, self.limit)
        np.maximum.at(high, self.owner, self.high)
        return low, high

    def forget(self) -> None:
        """Keeps the limits, not the rows: what was seen will be seen again."""
        none = np.zeros(0, np.int64)
        self.window, self.ids, self.scores = none, none, none

    def see(self, rows: Rows) -> None:
        for low in range(0, len(rows.ids), BLOCK):
            self._see(rows.part(low, low + BLOCK))

    def _see(self, rows: Rows) -> None:
        anchors = self.anchors
        near, far = rows.angles.min(axis=0), rows.angles.max(axis=0)
        nearest = np.maximum(np.maximum(anchors.angles - far, near - anchors.angles).max(axis=1), 0)
        farthest = np.minimum((anchors.angles + far).min(axis=1), (2 * np.pi - anchors.angles - near).min(axis=1))
        lowest, highest = score_bounds(anchors.norm, rows.norm.max(), nearest, farthest, rows.norm.min())
        low, high = self.open_limits()
        active = np.flatnonzero((highest >= low) & (lowest <= high))
        for start in range(0, len(active), _SLICE):
            self._score(rows, active[start : start + _SLICE])

    def _score(self, rows: Rows, own: np.ndarray) -> None:
        anchors = self.anchors
        low, high = (x[own][:, None] for x in self.open_limits())
        nearest, farthest = np.zeros((len(own), len(rows.ids))), np.full((len(own), len(rows.ids)), np.pi)
        for at in range(anchors.angles.shape[1]):
            a, b = anchors.angles[own, at][:, None], rows.angles[:, at][None, :]
            np.maximum(nearest, np.abs(a - b), out=nearest)
            total = a + b
            np.minimum(farthest, np.minimum(total, 2 * np.pi - total), out=farthest)
        lowest, highest = score_bounds(anchors.norm[own][:, None], rows.norm[None, :], nearest, farthest, rows.norm[None, :])
        fits = (highest >= low) & (lowest <= high) & (rows.ids[None, :] != anchors.ids[own][:, None])
        fits &= (rows.labels[None, :] == anchors.labels[own][:, None]) == self.same
        one, two = np.nonzero(fits)
        if not len(one):
            return
        self.scored += len(one)
        if anchors.largest * rows.largest * rows.points.shape[1] < 1 << 53:  # doubles hold every partial sum exactly
            scores = (anchors.points[own].astype(np.float64) @ rows.points.astype(np.float64).T)[one, two].astype(np.int64)
        else:
            scores = np.concatenate([(anchors.points[own[one[i : i + 4096]]] * rows.points[two[i : i + 4096]]).sum(axis=1) for i in range(0, len(one), 4096)])
        self._keep(own[one], rows.ids[two], scores)

    def _keep(self, owner: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        times = self.count[owner]
        at = np.repeat(np.arange(len(owner)), times)
        window = np.repeat(self.first[owner] - (np.cumsum(times) - times), times) + np.arange(len(at))
        inside = (scores[at] >= self.limit[window]) & (scores[at] <= self.high[window])
        at, window = at[inside], window[inside]
        window, ids, scores = np.append(self.window, window), np.append(self.ids, ids[at]), np.append(self.scores, scores[at])
        order = np.lexsort((ids, -scores, window))
        window, ids, scores = window[order], ids[order], scores[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        best = rank < self.most
        self.window, self.ids, self.scores, rank = window[best], ids[best], scores[best], rank[best]
        full = rank == self.most - 1
        self.limit[self.window[full]] = np.maximum(self.limit[self.window[full]], self.scores[full])


def _sampled(rows: DataFrame, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, integer vectors) per dimension of a bounded sample: the rows with the smallest hashes."""
    found = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).collect()
    out = {}
    for dim in {r["dim"] for r in found}:
        own = [r for r in found if r["dim"] == dim]
        out[dim] = np.array([r["vec_id"] for r in own]), np.array([r["label"] for r in own]), integers(np.array([r["v"] for r in own], np.float64), scale)
    return out


def _rows(ids: np.ndarray, labels: np.ndarray, points: np.ndarray, references: np.ndarray) -> Rows:
    norm = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))
    return Rows(ids, labels, points, norm, angles_to(points.astype(np.float64), norm, references))


def _search(table: DataFrame, block: dict, same: bool, most: int, references: dict, sample: dict) -> DataFrame:
    """(anchor_id, low, high, vec_id, score): the best rows of every task for each window of a block of anchors, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {}
        for dim, (ids, labels, points, owner, low, high) in block.items():
            own = references.get(dim)
            own = directions(np.zeros((0, dim)), dim) if own is None else own
            searches[dim] = Search(_rows(ids, labels, points, own), owner, low, high, same, most)
            if dim in sample:  # rows of the sample give limits, so a task without good rows returns none
                searches[dim].see(_rows(*sample[dim], own))
                searches[dim].forget()
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim in searches:
                    searches[dim].see(Rows.of(batch.filter(pa.array(dims == dim)), dim))
        for one in searches.values():
            if len(one.ids):
                columns = [one.anchors.ids[one.owner[one.window]], one.low[one.window], one.high[one.window], one.ids, one.scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "low", "high", "vec_id", "score"])

    return table.mapInArrow(run, "anchor_id long, low long, high long, vec_id long, score long")


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def _by_dim(rows: list, scale: int, windows) -> dict:
    """The anchors of a block per dimension, with the windows that windows(row) gives each."""
    out = {}
    for dim in {r["dim"] for r in rows}:
        own = [r for r in rows if r["dim"] == dim]
        each = [windows(r) for r in own]
        owner = np.repeat(np.arange(len(own)), [len(w) for w in each])
        limits = np.array([limit for w in each for limit in w], np.int64).reshape(-1, 2)
        points = integers(np.array([r["v"] for r in own], np.float64), scale)
        out[dim] = np.array([r["vec_id"] for r in own]), np.array([r["label"] for r in own]), points, owner, limits[:, 0].copy(), limits[:, 1].copy()
    return out


def window_of(score: int, low: int, high: int) -> list[tuple[int, int]]:
    """The scores n with low * score <= 100 * n <= high * score as one window, or none."""
    limits = -((-low * score) // 100), (high * score) // 100
    return [limits] if limits[0] <= limits[1] else []


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and each of its positives.

    Both tables have vec_id, embedding and label. Rows without an id or label and vectors that are null or empty or hold null
    or not finite numbers take no part; zero vectors do, with a score of 0. Only vectors of one dimension meet. Components
    become floor(scale * x); a score is the integer inner product, and products that might not fit 62 bits are an error.
    Higher scores come first, among equal ones the smaller id. Rows that repeat an id are candidates of their own but never
    of an anchor of that id; of anchors that repeat an id the one with the smallest vector and label is asked. Fewer
    candidates give fewer rows, empty tables none; other columns are ignored.
    """
    if not 0 <= low <= high:
        raise ValueError("low and high are hundredths, 0 <= low <= high")
    rows = usable(vectors)
    asked = usable(anchors).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("own")).select("vec_id", "own.v", "own.label")
    asked = saved(asked.withColumn("dim", F.size("v")))
    sample = _sampled(rows, scale)
    references = {dim: directions(points.astype(np.float64), dim) for dim, (_, _, points) in sample.items()}
    table = saved(index(rows, references, scale))
    parts = int((asked.agg(F.sum(8 * F.col("dim") + 100)).first()[0] or 0) // QUERY_BYTES) + 1

    def each_block(asked: DataFrame, same: bool, most: int, windows) -> DataFrame:
        """Blocks one after another, so the driver holds one of them and hands it to the tasks."""
        out = None
        for part in range(parts):
            block = _by_dim(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).collect(), scale, windows)
            found = saved(_ranked(_search(table, block, same, most, references, sample), ["anchor_id", "low", "high"], most))
            out = found if out is None else out.unionByName(found)
        return out

    best = each_block(asked, True, positives, lambda r: [(_NEVER, _ALWAYS)])
    best = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    scores = best.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))  # at most `positives` of an anchor
    with_scores = saved(asked.join(scores, asked["vec_id"] == scores["anchor_id"]).drop("anchor_id"))
    hard = each_block(with_scores, False, negatives, lambda r: [w for s in sorted(r["scores"]) for w in window_of(s, low, high)])
    hard = hard.select(F.col("anchor_id").alias("owner"), "low", "high", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # negative scores of positives have no window
    best = best.where("positive_score >= 0").withColumns({"least": F.expr(f"({low} * positive_score + 99) div 100"), "most": F.expr(f"({high} * positive_score) div 100")})
    met = best.join(hard, (best["anchor_id"] == hard["owner"]) & (best["least"] == hard["low"]) & (best["most"] == hard["high"]))
    return met.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
