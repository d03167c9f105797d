"""Gradient boosting for several classes: per stage one shallow regression tree per class on the softmax residuals.

Rows are binned once and written as blocks of bytes. A pass over them counts one level of all classes' trees, so a stage takes as
many passes as its trees have levels, and one for the steps of the leaves. No task holds more than a block, one histogram for each
node of the level, and the stages since scores were last written; nothing is cached in the executors.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.plans.trees import BINS, LEAF, Binned, Tree, _down, bin_rows
from panelkit.session import drop_written, shared_dir, written

CUT_EVERY = 10
WIDEST, DEEPEST = 1_024, 8  # features and levels of trees on binned rows; beyond them Spark's trees are fitted


class SoftmaxBoosting:
    """Fits raw scores F_k by stages; a leaf's step is the Newton step of the multinomial deviance."""

    def __init__(self, n_estimators: int = 150, learning_rate: float = 0.05, max_depth: int = 3, seed: int = 42):
        self.n_estimators, self.learning_rate, self.max_depth, self.seed = n_estimators, learning_rate, max_depth, seed

    def fit(self, train: DataFrame, classes: int) -> "SoftmaxBoostingModel":
        """``train`` has ``features`` and a class number ``y``."""
        shared_dir(train.sparkSession)
        first = train.select("features").first()
        if first is not None and first["features"].size <= WIDEST and self.max_depth <= DEEPEST:
            return self._fit_binned(bin_rows(train, None, classes, self.seed), classes)
        counts = {int(r["y"]): r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
        total = sum(counts.values())
        start = [math.log((counts.get(k, 0) or 1e-9) / total) for k in range(classes)]
        scores = F.array(*[F.lit(s) for s in start])
        # without column metadata every feature is a number to the trees, so every split has a threshold
        data = train.select(F.col("features").alias("features", metadata={}), "y", scores.alias("raw")).persist()
        stages = []
        for stage in range(self.n_estimators):
            stages.append(self._stage(data, classes, stage))
            if stage + 1 == self.n_estimators:
                break
            # each stage starts from kept scores; every few stages they are written out to end the lineage
            following = _advance(data, stages[-1], classes)
            if (stage + 1) % CUT_EVERY == 0:
                following = following.checkpoint()
            else:
                following = following.persist()
                following.count()
            data.unpersist()
            data = following
        data.unpersist()
        return SoftmaxBoostingModel.of(start, [[_flat(tree, steps) for tree, steps in stage] for stage in stages], classes)

    def _fit_binned(self, binned: Binned, classes: int) -> "SoftmaxBoostingModel":
        spark, paths = binned.table.sparkSession, [binned.path]
        start = [math.log((n or 1e-9) / binned.rows.sum()) for n in binned.rows.tolist()]
        table, stages, recent = binned.table, [], []
        try:
            for stage in range(self.n_estimators):
                scored = _Scored(table, len(binned.cuts), start, recent)
                trees = [Tree.root(0) for _ in range(classes)]
                level = [(k, 0) for k in range(classes)]
                for _ in range(self.max_depth):
                    found = scored.best(trees, level, self.max_depth) if level else []
                    level = []
                    for r in sorted(found, key=lambda r: (r["k"], r["node"])):
                        if r["feature"] != LEAF:
                            tree, first = trees[r["k"]], len(trees[r["k"]].feature)
                            tree.feature[r["node"]], tree.cut[r["node"]], tree.left[r["node"]] = r["feature"], r["cut"], first
                            trees[r["k"]] = tree.grown(Tree.root(0)).grown(Tree.root(0))
                            level += [(r["k"], first), (r["k"], first + 1)]
                steps = [np.zeros(len(t.feature)) for t in trees]
                for r in scored.leaves(trees, self.max_depth):
                    step = (classes - 1) / classes * r["top"] / r["bottom"] if abs(r["bottom"]) > 1e-150 else 0.0
                    steps[r["k"]][r["node"]] = self.learning_rate * step
                recent.append((trees, steps, self.max_depth))
                stages.append([_flat_bins(t, own, binned.cuts) for t, own in zip(trees, steps)])
                if (stage + 1) % CUT_EVERY == 0 and stage + 1 < self.n_estimators:
                    # later passes start from written scores
                    table, path = written(_Scored(table, len(binned.cuts), start, recent).advanced(), "scores")
                    drop_written(spark, paths.pop())
                    paths.append(path)
                    recent = []
        finally:
            drop_written(spark, paths[-1])
        return SoftmaxBoostingModel.of(start, stages, classes)

    def _stage(self, data: DataFrame, classes: int, stage: int) -> list[tuple]:
        chances = _softmax(classes)
        residuals = data.select(
            "features",
            *[((F.col("y") == k).cast("double") - chances[k]).alias(f"r{k}") for k in range(classes)],
        ).persist()
        trees = [
            DecisionTreeRegressor(
                featuresCol="features", labelCol=f"r{k}", predictionCol=f"__p{k}", leafCol=f"leaf{k}",
                maxDepth=self.max_depth, maxBins=64, seed=self.seed + stage,
            ).fit(residuals)
            for k in range(classes)
        ]
        leaves = residuals
        for tree in trees:
            leaves = tree.transform(leaves)
        cells = [
            F.struct(F.lit(k).alias("k"), F.col(f"leaf{k}").cast("int").alias("leaf"), F.col(f"r{k}").alias("r"))
            for k in range(classes)
        ]
        # as many rows as the trees have leaves
        sums = (
            leaves.select(F.inline(F.array(*cells))).groupBy("k", "leaf")
            .agg(F.sum("r").alias("top"), F.sum(F.abs("r") * (1 - F.abs("r"))).alias("bottom")).collect()
        )
        residuals.unpersist()
        steps: list[dict[int, float]] = [{} for _ in range(classes)]
        for r in sums:
            step = (classes - 1) / classes * r["top"] / r["bottom"] if abs(r["bottom"]) > 1e-150 else 0.0
            steps[r["k"]][r["leaf"]] = self.learning_rate * step
        return [(tree, [s.get(i, 0.0) for i in range(max(s, default=0) + 1)]) for tree, s in zip(trees, steps)]


class _Scored:
    """Passes over binned blocks whose raw scores are those written with them (else ``start``) and the ``recent`` stages'."""

    def __init__(self, table: DataFrame, width: int, start: list[float], recent: list):
        self.table, self.width, self.start, self.recent = table, width, start, list(recent)

    def _blocks(self):
        width, start, recent = self.width, np.array(self.start), self.recent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            """(bins, y, raw) of each block."""
            for batch in batches:
                for i in range(batch.num_rows):
                    bins = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(-1, width)
                    y = np.frombuffer(batch.column("y")[i].as_buffer(), np.int16)
                    if "raw" in batch.schema.names:
                        raw = np.frombuffer(batch.column("raw")[i].as_buffer(), np.float64).reshape(-1, len(start)).copy()
                    else:
                        raw = np.tile(start, (len(y), 1))
                    for trees, steps, depth in recent:
                        for k, tree in enumerate(trees):
                            raw[:, k] += steps[k][_down(tree, bins, depth)]
                    yield bins, y, raw

        return run

    def advanced(self) -> DataFrame:
        blocks = self._blocks()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, y, raw in blocks(batches):
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "bins": pa.array([bins.tobytes()]), "y": pa.array([y.tobytes()]), "raw": pa.array([raw.tobytes()])})

        return self.table.mapInArrow(run, "n int, bins binary, y binary, raw binary")

    def best(self, trees: list[Tree], level: list[tuple[int, int]], depth: int) -> list:
        """The best split by variance of each (class, node) of ``level``: k, node, feature (or LEAF) and cut."""
        blocks, width = self._blocks(), self.width
        place = [np.full(len(t.feature), -1) for t in trees]
        for i, (k, node) in enumerate(level):
            place[k][node] = i

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(level), 2, width * BINS))
            for bins, y, raw in blocks(batches):
                rest = _residuals(y, raw)
                for k, tree in enumerate(trees):
                    slot = place[k][_down(tree, bins, depth)]
                    here = np.flatnonzero(slot >= 0)
                    own, at = np.unique(slot[here], return_inverse=True)
                    if not len(own):
                        continue
                    key = ((at[:, None] * width + np.arange(width)) * BINS + bins[here]).reshape(-1)
                    size = len(own) * width * BINS
                    total[own, 0] += np.bincount(key, minlength=size).reshape(len(own), -1)
                    total[own, 1] += np.bincount(key, np.repeat(rest[here, k], width), size).reshape(len(own), -1)
            for i in np.flatnonzero(total[:, 0].any(axis=1)):
                yield pa.RecordBatch.from_pydict({"k": pa.array([level[i][0]], pa.int32()), "node": pa.array([level[i][1]], pa.int32()), "sums": pa.array([total[i].tobytes()])})

        def split(group: pa.Table) -> pa.Table:
            # summed in an order of their own, so that a tree does not depend on which task was first
            sums = sum(np.frombuffer(c, np.float64) for c in sorted(group.column("sums").to_pylist())).reshape(2, width, BINS)
            feature, cut = _best_by_variance(*sums)
            return pa.table({"k": group.column("k").slice(0, 1), "node": group.column("node").slice(0, 1), "feature": pa.array([feature], pa.int32()), "cut": pa.array([cut], pa.int32())})

        counted = self.table.mapInArrow(count, "k int, node int, sums binary")
        return counted.groupBy("k", "node").applyInArrow(split, "k int, node int, feature int, cut int").collect()

    def leaves(self, trees: list[Tree], depth: int) -> list:
        """Of each class and leaf the sums that its Newton step is made of."""
        blocks = self._blocks()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((2, len(t.feature))) for t in trees]
            for bins, y, raw in blocks(batches):
                rest = _residuals(y, raw)
                for k, tree in enumerate(trees):
                    node, r = _down(tree, bins, depth), rest[:, k]
                    total[k][0] += np.bincount(node, r, len(tree.feature))
                    total[k][1] += np.bincount(node, np.abs(r) * (1 - np.abs(r)), len(tree.feature))
            for k, own in enumerate(total):
                nodes = np.flatnonzero(trees[k].feature == LEAF)
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(nodes), k), pa.int32()), "node": pa.array(nodes, pa.int32()), "top": pa.array(own[0][nodes]), "bottom": pa.array(own[1][nodes])})

        sums = self.table.mapInArrow(run, "k int, node int, top double, bottom double")
        return sums.groupBy("k", "node").agg(F.sum("top").alias("top"), F.sum("bottom").alias("bottom")).collect()


def _residuals(y: np.ndarray, raw: np.ndarray) -> np.ndarray:
    chance = np.exp(raw - raw.max(axis=1, keepdims=True))
    rest = -chance / chance.sum(axis=1, keepdims=True)
    rest[np.arange(len(y)), y] += 1
    return rest


def _best_by_variance(counts: np.ndarray, sums: np.ndarray) -> tuple[int, int]:
    """(feature, cut) that lowers the variance most, the first of equal ones; LEAF where none does."""
    left, top = np.cumsum(counts, axis=1), np.cumsum(sums, axis=1)
    n, whole = left[:, -1:], top[:, -1:]
    left, top = left[:, :-1], top[:, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (top**2 / left + (whole - top) ** 2 / (n - left) - whole**2 / n) / n
    # what rounding alone can make is no gain
    gain = np.where((left > 0) & (left < n) & (gain > 1e-13), gain, -np.inf)
    feature, cut = divmod(int(gain.argmax()), BINS - 1)
    return (feature, cut) if np.isfinite(gain[feature, cut]) else (LEAF, 0)


def _flat_bins(tree: Tree, steps: np.ndarray, cuts: list[np.ndarray]) -> dict[str, list]:
    """A tree on bins as _flat() gives Spark's."""
    nodes: dict[str, list] = {"feature": [], "threshold": [], "right": [], "step": []}

    def add(at: int) -> None:
        own, feature = len(nodes["feature"]), int(tree.feature[at])
        inner = feature != LEAF
        for name, value in (("feature", feature), ("threshold", float(cuts[feature][tree.cut[at]]) if inner else 0.0), ("right", 0), ("step", 0.0 if inner else float(steps[at]))):
            nodes[name].append(value)
        if inner:
            add(int(tree.left[at]))
            nodes["right"][own] = len(nodes["feature"])
            add(int(tree.left[at]) + 1)

    add(0)
    return nodes


def _softmax(classes: int):
    top = F.array_max("raw")
    parts = [F.exp(F.get("raw", F.lit(k)) - top) for k in range(classes)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]


def _advance(data: DataFrame, stage: list[tuple], classes: int) -> DataFrame:
    """Adds one stage's steps to the raw scores."""
    kept = data.columns
    for tree, _ in stage:
        data = tree.transform(data)
    raised = [
        F.get("raw", F.lit(k)) + F.coalesce(F.get(F.array(*[F.lit(s) for s in steps]), F.col(f"leaf{k}").cast("int")), F.lit(0.0))
        for k, (_, steps) in enumerate(stage)
    ]
    return data.withColumn("raw", F.array(*raised)).select(*kept)


def _flat(tree, steps: list[float]) -> dict[str, list]:
    """A fitted tree as arrays in preorder: feature (-1 at a leaf), threshold, right child, and the leaf's step.

    Leaves come in the order in which Spark numbers them.
    """
    nodes: dict[str, list] = {"feature": [], "threshold": [], "right": [], "step": []}
    leaves = iter(range(1 << 31))

    def add(node) -> None:
        at = len(nodes["feature"])
        for column in nodes.values():
            column.append(0)
        if "InternalNode" not in node.getClass().getName():
            leaf = next(leaves)
            nodes["feature"][at], nodes["threshold"][at] = -1, 0.0
            nodes["step"][at] = float(steps[leaf]) if leaf < len(steps) else 0.0
            return
        split = node.split()
        nodes["feature"][at], nodes["threshold"][at], nodes["step"][at] = int(split.featureIndex()), float(split.threshold()), 0.0
        add(node.leftChild())
        nodes["right"][at] = len(nodes["feature"])
        add(node.rightChild())

    add(tree._java_obj.rootNode())
    return nodes


class SoftmaxBoostingModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Flat trees as one JSON parameter, so the model saves and loads inside a pipeline like any other stage."""

    trees = Param(Params._dummy(), "trees", "start scores, classes and trees", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    @classmethod
    def of(cls, start: list[float], stages: list[list[dict[str, list]]], classes: int) -> "SoftmaxBoostingModel":
        described = {"start": start, "classes": classes, "stages": stages}
        model = cls()
        model._set(trees=json.dumps(described))
        return model

    @property
    def stages(self) -> list[list[dict[str, list]]]:
        return json.loads(self.getOrDefault(self.trees))["stages"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``prediction``: the class with the highest raw score, the smaller number in a tie.

        Every tree reads the features once: the work is linear in the number of stages.
        """
        text = self.getOrDefault(self.trees)

        @F.pandas_udf("double")
        def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = json.loads(text)
            stages = [[{k: np.array(v) for k, v in tree.items()} for tree in stage] for stage in known["stages"]]
            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 1))
                raw = np.tile(np.array(known["start"]), (len(x), 1))
                rows = np.arange(len(x))
                for stage in stages:
                    for k, tree in enumerate(stage):
                        at = np.zeros(len(x), np.int64)
                        while True:
                            feature = tree["feature"][at]
                            inner = feature >= 0
                            if not inner.any():
                                break
                            left = x[rows, np.maximum(feature, 0)] <= tree["threshold"][at]
                            at = np.where(inner, np.where(left, at + 1, tree["right"][at]), at)
                        raw[:, k] += tree["step"][at]
                yield pd.Series(raw.argmax(axis=1).astype(float))

        return dataset.withColumn("prediction", best(vector_to_array("features")))
