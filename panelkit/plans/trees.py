"""Classification trees on binned features, split by Gini impurity.

Rows are binned once (at most 64 bins a feature, cut by a sample) and written as blocks of bytes. Large nodes are split level by
level: each task hands on one histogram for each of them, and the best split is found where a node's histograms meet. Once a
node holds few rows, these meet in one task that grows the node's whole subtree, so what is shuffled goes by rows and by large
nodes, never by tasks times the small nodes of deep levels. Histograms are whole numbers: a tree does not depend on how rows are dealt.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import drop_written, written

BINS = 64
SAMPLE = 20_000  # rows that say where to cut; all rows are counted
LEAST_LOCAL, MOST_LOCAL = 50_000, 500_000  # rows of a node whose subtree one task grows
PASS_NODES = 256  # large nodes that one pass counts
CELLS, NUMBERS = 1 << 21, 1 << 22  # of histograms, and of row numbers, that are held at a time
FOREST_ROWS = 1_000_000  # rows up to which each tree of a forest is one task's work, which holds all of them
LEAF = -1


@dataclass
class Tree:
    """Nodes in arrays; the right child follows the left. ``label`` is the class that a node tells, were it a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    label: np.ndarray

    @staticmethod
    def root(label: int) -> "Tree":
        return Tree(np.array([LEAF], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.array([label], np.int16))

    def grown(self, other: "Tree") -> "Tree":
        return Tree(*(np.concatenate([getattr(self, n), getattr(other, n)]) for n in ("feature", "cut", "left", "label")))


@dataclass
class Binned:
    """Written rows (n, bins, y) in blocks, and what is known of them."""

    table: DataFrame
    path: str
    cuts: list[np.ndarray]
    rows: np.ndarray  # of each class
    weights: np.ndarray  # of a row of each class


def matrix(column: pa.StructArray, width: int) -> np.ndarray:
    """The numbers of a column of vectors, sparse or dense."""
    kind, _, places, numbers = column.flatten()
    dense = kind.to_numpy(zero_copy_only=False) == 1
    ends, flat = numbers.offsets.to_numpy(), numbers.values.to_numpy()
    flat, lengths = flat[ends[0] : ends[-1]], np.diff(ends)
    if dense.all():
        return flat.reshape(-1, width)
    out, own = np.zeros((len(dense), width)), np.repeat(dense, lengths)
    out[dense] = flat[own].reshape(-1, width)
    at, index = places.offsets.to_numpy(), places.values.to_numpy()
    out[np.repeat(np.arange(len(dense)), np.diff(at)), index[at[0] : at[-1]]] = flat[~own]
    return out


def cuts_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Between all distinct values where they are few, else at about equal numbers of rows."""
    known, counts = np.unique(values, return_counts=True)
    middles = (known[:-1] + known[1:]) / 2
    if len(known) <= bins:
        return middles
    below = np.cumsum(counts)[:-1]
    wanted = np.arange(1, bins) * (len(values) / bins)
    after = np.clip(np.searchsorted(below, wanted), 1, len(below) - 1)
    nearest = np.where(wanted - below[after - 1] <= below[after] - wanted, after - 1, after)
    return middles[np.unique(nearest)]


def bin_rows(train: DataFrame, weight: str | None, classes: int, seed: int) -> Binned | None:
    """``train`` (y, features and, if named, a weight) in bins; None where rows of a class differ in weight."""
    told = F.col(weight) if weight else F.lit(1.0)
    sizes = train.groupBy("y").agg(F.count("*").alias("n"), F.min(told).alias("low"), F.max(told).alias("high")).collect()
    if any(r["y"] is None for r in sizes):
        raise ValueError("a training row has no class")
    if any(r["low"] != r["high"] for r in sizes):
        return None
    rows, weights = np.zeros(classes, np.int64), np.ones(classes)
    for r in sizes:
        rows[int(r["y"])], weights[int(r["y"])] = r["n"], r["low"]
    total = int(rows.sum())
    if not total:
        raise ValueError("no rows to fit")
    chosen = train.select(vector_to_array("features").alias("x"))
    if total > SAMPLE:
        chosen = chosen.sample(min(1.0, SAMPLE / total), seed)
    found = chosen.toArrow().column(0).combine_chunks()
    if not len(found):
        found = train.select(vector_to_array("features").alias("x")).limit(SAMPLE).toArrow().column(0).combine_chunks()
    known = found.flatten().to_numpy().reshape(len(found), -1)
    cuts = [cuts_of(known[:, f]) for f in range(known.shape[1])]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), len(cuts))
            bins = np.empty(x.shape, np.uint8)
            for f, own in enumerate(cuts):
                bins[:, f] = np.searchsorted(own, x[:, f])
            y = batch.column(0).to_numpy().astype(np.int16)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), "bins": pa.array([bins.tobytes()]), "y": pa.array([y.tobytes()])})

    table, path = written(train.select("y", "features").mapInArrow(binned, "n int, bins binary, y binary"), "bins")
    return Binned(table, path, cuts, rows, weights)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bins, y) of the rows, about NUMBERS bins at a time."""
    held, size = [], 0
    for batch in batches:
        for bins, y in zip(batch.column("bins"), batch.column("y")):
            held.append((np.frombuffer(bins.as_buffer(), np.uint8).reshape(-1, width), np.frombuffer(y.as_buffer(), np.int16)))
            size += held[-1][0].size
            if size >= NUMBERS:
                yield np.concatenate([b for b, _ in held]), np.concatenate([y for _, y in held])
                held, size = [], 0
    if held:
        yield np.concatenate([b for b, _ in held]), np.concatenate([y for _, y in held])


def histograms(bins: np.ndarray, y: np.ndarray, slot: np.ndarray, nodes: int, classes: int) -> np.ndarray:
    """(node, feature, bin, class) counts of the rows with their node's number."""
    width = bins.shape[1]
    size, out = nodes * width * BINS * classes, None
    step = max(1, NUMBERS // width)
    for low in range(0, len(bins), step):
        part = slice(low, low + step)
        key = ((slot[part, None].astype(np.int64) * width + np.arange(width)) * BINS + bins[part]) * classes + y[part, None]
        found = np.bincount(key.reshape(-1), minlength=size)
        out = found if out is None else out + found
    out = np.zeros(size, np.int64) if out is None else out
    return out.reshape(nodes, width, BINS, classes)


def best_splits(counts: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature or LEAF, cut, counts of the left child, counts of the right) of each histogram; the first of equal splits."""
    nodes, width, _, classes = counts.shape
    left = np.cumsum(counts, axis=2)
    total = left[:, :, -1:, :]
    left = left[:, :, :-1, :]
    right = total - left
    fits = (left.sum(-1) >= least) & (right.sum(-1) >= least)
    a, b, every = left * weights, right * weights, total[:, :1] * weights
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (a**2).sum(-1) / a.sum(-1) + (b**2).sum(-1) / b.sum(-1)
        whole = every.sum(-1)
        gain = (score - (every**2).sum(-1) / whole) / whole
    # what rounding alone can make is no gain
    gain = np.where(fits & (gain > 1e-13), gain, -np.inf).reshape(nodes, -1)
    at = gain.argmax(axis=1)
    own = np.arange(nodes)
    feature, cut = np.divmod(at, BINS - 1)
    feature = np.where(np.isfinite(gain[own, at]), feature, LEAF)
    return feature, cut, left[own, feature, cut], right[own, feature, cut]


def _label(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (counts * weights).argmax(axis=-1)


def grow_here(
    bins: np.ndarray, y: np.ndarray, depth: int, least: int, weights: np.ndarray,
    some: int | None = None, draw: np.random.Generator | None = None, counts: list[np.ndarray] | None = None,
) -> Tree:
    """The whole tree of rows that one task holds.

    With ``some`` each node is split by the best of so many features, drawn by ``draw``. ``counts`` gets the class counts of all nodes.
    """
    classes, width = len(weights), some or bins.shape[1]
    sizes = np.bincount(y, minlength=classes)[None]
    if counts is not None:
        counts.append(sizes)
    tree = Tree.root(int(_label(sizes, weights)[0]))
    at, slot = np.arange(len(y)), np.zeros(len(y), np.int64)
    ids = np.zeros(1, np.int64)
    for _ in range(depth):
        # nodes that may split, by number; rows of others are done
        open_ = ((sizes > 0).sum(axis=1) > 1) & (sizes.sum(axis=1) >= 2 * least)
        place = np.where(open_, np.cumsum(open_) - 1, -1)
        slot = place[slot]
        at, slot = at[slot >= 0], slot[slot >= 0]
        ids, sizes = ids[open_], sizes[open_]
        if not len(ids):
            break
        order = np.argsort(slot, kind="stable")
        at, slot = at[order], slot[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=len(ids)))])
        step = max(1, CELLS // (width * BINS * classes))
        parts = []
        for low in range(0, len(ids), step):
            high = min(low + step, len(ids))
            rows = slice(ends[low], ends[high])
            if some is None:
                parts.append(best_splits(histograms(bins[at[rows]], y[at[rows]], slot[rows] - low, high - low, classes), weights, least))
                continue
            drawn = np.sort(draw.random((high - low, bins.shape[1])).argpartition(some - 1, axis=1)[:, :some], axis=1)
            seen = bins[at[rows][:, None], drawn[slot[rows] - low]]
            chosen, *rest = best_splits(histograms(seen, y[at[rows]], slot[rows] - low, high - low, classes), weights, least)
            parts.append((np.where(chosen == LEAF, LEAF, drawn[np.arange(high - low), np.maximum(chosen, 0)]), *rest))
        feature, cut, left, right = (np.concatenate(p) for p in zip(*parts))
        split = feature != LEAF
        first = len(tree.feature) + 2 * (np.cumsum(split) - 1)
        tree.feature[ids], tree.cut[ids], tree.left[ids] = feature, np.where(split, cut, 0), np.where(split, first, 0)
        sizes = np.stack([left[split], right[split]], axis=1).reshape(-1, classes)
        if counts is not None:
            counts.append(sizes)
        more = len(sizes)
        ids = np.arange(len(tree.feature), len(tree.feature) + more)
        tree = tree.grown(Tree(np.full(more, LEAF, np.int16), np.zeros(more, np.uint8), np.zeros(more, np.int32), _label(sizes, weights).astype(np.int16)))
        at, slot = at[split[slot]], slot[split[slot]]
        child = 2 * (np.cumsum(split) - 1)
        slot = child[slot] + (bins[at, feature[slot]] > cut[slot])
    return tree


def _down(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row comes to."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        feature = tree.feature[node]
        inner = feature != LEAF
        if not inner.any():
            break
        node = np.where(inner, tree.left[node] + (bins[rows, np.maximum(feature, 0)] > tree.cut[node]), node)
    return node


def grow(binned: Binned, depth: int, least: int) -> Tree:
    """A tree of at most ``depth`` levels whose leaves hold ``least`` rows or more."""
    spark = binned.table.sparkSession
    cores, weights = spark.sparkContext.defaultParallelism, binned.weights
    classes, width, least = len(weights), len(binned.cuts), max(1, least)
    local = int(min(MOST_LOCAL, max(LEAST_LOCAL, binned.rows.sum() // (2 * cores))))
    tree = Tree.root(int(_label(binned.rows, weights)))
    level, waiting = {0: binned.rows}, {}
    for done in range(depth):
        splits = {i: c for i, c in level.items() if (c > 0).sum() > 1 and c.sum() >= 2 * least}
        waiting |= {i: depth - done for i, c in splits.items() if c.sum() <= local}
        large = [i for i in splits if i not in waiting]
        level, found = {}, []
        for low in range(0, len(large), PASS_NODES):
            found += _best(binned, tree, np.array(large[low : low + PASS_NODES]), done, least)
        for r in sorted(found, key=lambda r: r["node"]):
            if r["feature"] == LEAF:
                continue
            node, first = r["node"], len(tree.feature)
            tree.feature[node], tree.cut[node], tree.left[node] = r["feature"], r["cut"], first
            children = np.array([r["left"], r["right"]], np.int64)
            tree = tree.grown(Tree(np.full(2, LEAF, np.int16), np.zeros(2, np.uint8), np.zeros(2, np.int32), _label(children, weights).astype(np.int16)))
            level |= {first: children[0], first + 1: children[1]}
        if not level:
            break
    return _subtrees(binned, tree, waiting, depth, least) if waiting else tree


def _best(binned: Binned, tree: Tree, nodes: np.ndarray, depth: int, least: int) -> list:
    """The best split of each of the ``nodes``, counted over all rows."""
    width, classes, weights = len(binned.cuts), len(binned.weights), binned.weights
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(nodes), width, BINS, classes), np.int64)
        for bins, y in _blocks(batches, width):
            slot = place[_down(tree, bins, depth)]
            here = slot >= 0
            if here.any():
                total += histograms(bins[here], y[here], slot[here], len(nodes), classes)
        for i in np.flatnonzero(total.any(axis=(1, 2, 3))):
            yield pa.RecordBatch.from_pydict({"node": pa.array([nodes[i]], pa.int32()), "counts": pa.array([total[i].tobytes()])})

    def split(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in group.column("counts"))
        feature, cut, left, right = best_splits(total.reshape(1, width, BINS, classes), weights, least)
        lists = pa.list_(pa.int64())
        return pa.table({"node": group.column("node").slice(0, 1), "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32()), "left": pa.array(left.tolist(), lists), "right": pa.array(right.tolist(), lists)})

    counted = binned.table.mapInArrow(count, "node int, counts binary")
    return counted.groupBy("node").applyInArrow(split, "node int, feature int, cut int, left array<long>, right array<long>").collect()


def _subtrees(binned: Binned, tree: Tree, waiting: dict[int, int], depth: int, least: int) -> Tree:
    """``tree`` with the subtrees of its ``waiting`` nodes, each of at most so many levels."""
    width, weights = len(binned.cuts), binned.weights
    waits = np.zeros(len(tree.feature), bool)
    waits[list(waiting)] = True

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y in _blocks(batches, width):
            node = _down(tree, bins, depth)
            order = np.argsort(node, kind="stable")
            order = order[waits[node[order]]]
            numbers, starts = np.unique(node[order], return_index=True)
            parts = np.split(order, starts[1:])
            if len(numbers):
                yield pa.RecordBatch.from_pydict({"node": pa.array(numbers, pa.int32()), "bins": pa.array([bins[p].tobytes() for p in parts]), "y": pa.array([y[p].tobytes() for p in parts])})

    def rest(group: pa.Table) -> pa.Table:
        node = group.column("node")[0].as_py()
        # the order in which rows arrive changes no count
        bins = np.concatenate([np.frombuffer(b.as_buffer(), np.uint8) for b in group.column("bins")]).reshape(-1, width)
        y = np.concatenate([np.frombuffer(v.as_buffer(), np.int16) for v in group.column("y")])
        own = grow_here(bins, y, waiting[node], least, weights)
        return pa.table({"node": pa.array([node], pa.int32()), **{n: pa.array([getattr(own, n).tobytes()]) for n in ("feature", "cut", "left", "label")}})

    dealt = binned.table.mapInArrow(deal, "node int, bins binary, y binary")
    # a node is one task's work, however few bytes it has
    dealt = dealt.repartition(min(2 * len(waiting), 4 * binned.table.sparkSession.sparkContext.defaultParallelism), "node")
    found = dealt.groupBy("node").applyInArrow(rest, "node int, feature binary, cut binary, left binary, label binary").collect()
    parts, size = [tree], len(tree.feature)
    for r in sorted(found, key=lambda r: r["node"]):
        own = Tree(*(np.frombuffer(r[n], d).copy() for n, d in (("feature", np.int16), ("cut", np.uint8), ("left", np.int32), ("label", np.int16))))
        # the root of the subtree is the node itself
        own.left = np.where(own.feature != LEAF, own.left + (size - 1), 0).astype(np.int32)
        node = r["node"]
        tree.feature[node], tree.cut[node], tree.left[node] = own.feature[0], own.cut[0], own.left[0]
        parts.append(Tree(own.feature[1:], own.cut[1:], own.left[1:], own.label[1:]))
        size += len(own.feature) - 1
    return Tree(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("feature", "cut", "left", "label")))


class TreeModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A tree as one text parameter, so the model saves and loads inside a pipeline like any other stage."""

    tree = Param(Params._dummy(), "tree", "nodes and cuts", TypeConverters.toString)
    depth = Param(Params._dummy(), "depth", "levels that are used", TypeConverters.toInt)

    def __init__(self):
        super().__init__()

    @classmethod
    def of(cls, tree: Tree, cuts: list[np.ndarray], depth: int) -> "TreeModel":
        packed = io.BytesIO()
        np.savez_compressed(packed, feature=tree.feature, cut=tree.cut, left=tree.left, label=tree.label, cuts=np.concatenate([*cuts, np.zeros(0)]), widths=np.array([len(c) for c in cuts]))
        model = cls()
        model._set(tree=base64.b64encode(packed.getvalue()).decode(), depth=depth)
        return model

    def cut_off(self, depth: int) -> "TreeModel":
        """The tree that would have been grown to ``depth`` levels: no split depends on the levels below it."""
        model = type(self)()
        model._set(tree=self.getOrDefault(self.tree), depth=depth)
        return model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``prediction``."""
        text, depth = self.getOrDefault(self.tree), self.getOrDefault(self.depth)

        @F.arrow_udf("double")
        def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = np.load(io.BytesIO(base64.b64decode(text)))
            feature, cut, left, label, cuts = (known[n] for n in ("feature", "cut", "left", "label", "cuts"))
            starts = np.concatenate([[0], np.cumsum(known["widths"])])
            threshold = cuts[np.minimum(starts[np.maximum(feature, 0)] + cut, max(len(cuts) - 1, 0))] if len(cuts) else np.zeros(len(feature))
            for batch in batches:
                x, rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1), np.arange(len(batch))
                node = np.zeros(len(batch), np.int64)
                for _ in range(depth):
                    own = feature[node]
                    inner = own != LEAF
                    if not inner.any():
                        break
                    node = np.where(inner, left[node] + (x[rows, np.maximum(own, 0)] > threshold[node]), node)
                yield pa.array(label[node].astype(float))

        return dataset.withColumn("prediction", told(vector_to_array("features")))


def fit_tree(train: DataFrame, classes: int, depth: int, least: int, weight: str | None, seed: int) -> TreeModel | None:
    """The tree of ``train`` (y, features and, if named, a weight); None where rows of a class differ in weight."""
    binned = bin_rows(train, weight, classes, seed)
    if binned is None:
        return None
    try:
        return TreeModel.of(grow(binned, depth, least), binned.cuts, depth)
    finally:
        drop_written(train.sparkSession, binned.path)


class ForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as one text parameter. A row's class is that of the largest sum of its leaves' class shares."""

    forest = Param(Params._dummy(), "forest", "nodes, shares and cuts", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``prediction``."""
        text = self.getOrDefault(self.forest)

        @F.arrow_udf("double")
        def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = np.load(io.BytesIO(base64.b64decode(text)))
            feature, cut, left, share, cuts, roots = (known[n] for n in ("feature", "cut", "left", "share", "cuts", "roots"))
            starts = np.concatenate([[0], np.cumsum(known["widths"])])
            threshold = cuts[np.minimum(starts[np.maximum(feature, 0)] + cut, max(len(cuts) - 1, 0))] if len(cuts) else np.zeros(len(feature))
            for batch in batches:
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                total = np.zeros((len(batch), share.shape[1]))
                for root in roots:
                    node, going = np.full(len(batch), root), np.arange(len(batch))
                    while len(going):
                        own = node[going]
                        inner = feature[own] != LEAF
                        going, own = going[inner], own[inner]
                        node[going] = left[own] + (x[going, feature[own]] > threshold[own])
                    total += share[node]
                yield pa.array(total.argmax(axis=1).astype(float))

        return dataset.withColumn("prediction", told(vector_to_array("features")))


def fit_forest(train: DataFrame, classes: int, trees: int, depth: int, least: int, weight: str | None, seed: int) -> ForestModel | None:
    """Trees on rows drawn with replacement, each node split by the best of a root's number of features. Every tree is a task's
    work; None where the rows are too many for that, or those of a class differ in weight."""
    if train.count() > FOREST_ROWS:
        return None
    binned = bin_rows(train, weight, classes, seed)
    if binned is None:
        return None
    spark, width, weights, least = train.sparkSession, len(binned.cuts), binned.weights, max(1, least)
    some = max(1, int(np.ceil(np.sqrt(width))))
    try:
        rows = binned.table.select("bins", "y").toArrow()
    finally:
        drop_written(spark, binned.path)
    held = spark.sparkContext.broadcast((b"".join(rows.column("bins").to_pylist()), b"".join(rows.column("y").to_pylist())))

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y = np.frombuffer(held.value[0], np.uint8).reshape(-1, width), np.frombuffer(held.value[1], np.int16)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                draw, counts = np.random.default_rng([seed, number]), []
                at = np.repeat(np.arange(len(y)), draw.poisson(1.0, len(y)))
                if not len(at):
                    at = np.arange(len(y))
                own = grow_here(bins[at], y[at], depth, least, weights, some, draw, counts)
                share = np.concatenate(counts) * weights
                share = (share / share.sum(axis=1, keepdims=True)).astype(np.float32)
                yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), **{n: pa.array([getattr(own, n).tobytes()]) for n in ("feature", "cut", "left")}, "share": pa.array([share.tobytes()])})

    tasks = min(trees, 4 * spark.sparkContext.defaultParallelism)
    found = spark.range(0, trees, 1, tasks).mapInArrow(grown, "number long, feature binary, cut binary, left binary, share binary").collect()
    held.unpersist()
    parts: dict[str, list] = {"feature": [], "cut": [], "left": [], "share": []}
    roots, size = [], 0
    for r in sorted(found, key=lambda r: r["number"]):
        own = {n: np.frombuffer(r[n], d) for n, d in (("feature", np.int16), ("cut", np.uint8), ("left", np.int32), ("share", np.float32))}
        roots.append(size)
        own["left"] = own["left"] + size
        own["share"] = own["share"].reshape(-1, classes)
        size += len(own["feature"])
        for n, v in own.items():
            parts[n].append(v)
    packed = io.BytesIO()
    np.savez_compressed(packed, roots=np.array(roots), cuts=np.concatenate([*binned.cuts, np.zeros(0)]), widths=np.array([len(c) for c in binned.cuts]), **{n: np.concatenate(v) for n, v in parts.items()})
    model = ForestModel()
    model._set(forest=base64.b64encode(packed.getvalue()).decode())
    return model
