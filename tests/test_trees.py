"""Trees on binned rows against a plain one and against Spark's."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from checks import catalog_models
from panelkit.plans import boosting, models, trees


def made(spark, n=3_000, seed=4, sparse=True):
    g = np.random.default_rng(seed)
    x = np.column_stack([g.normal(size=n).round(1), g.integers(0, 2, n), g.integers(0, 5, n) * 1.5, g.normal(size=n), np.zeros(n)])
    y = ((x[:, 0] > 0.3) + (x[:, 1] * x[:, 2] > 2) + (g.random(n) < 0.1)).clip(0, 2)
    kind = lambda i, r: SparseVector(5, {j: float(v) for j, v in enumerate(r) if v}) if sparse and i % 2 else Vectors.dense(r)
    rows = [(i, float(y[i]), kind(i, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, ["row_id", "y", "features"]).repartition(5).cache(), x, y.astype(int)


def plain(bins, y, depth, least, weights):
    """One node after the other: the class that each row is told."""
    sizes = np.bincount(y, minlength=len(weights)) * weights
    told, best = np.full(len(y), sizes.argmax()), (1e-13, None)
    if depth == 0:
        return told
    gini = lambda c: 1 - ((c / c.sum()) ** 2).sum()
    for f in range(bins.shape[1]):
        for cut in np.unique(bins[:, f])[:-1]:
            low = bins[:, f] <= cut
            if least <= low.sum() <= len(y) - least:
                a, b = (np.bincount(y[s], minlength=len(weights)) * weights for s in (low, ~low))
                gain = gini(sizes) - (a.sum() * gini(a) + b.sum() * gini(b)) / sizes.sum()
                if gain > best[0] + 1e-12:
                    best = gain, low
    if best[1] is not None:
        for side in (best[1], ~best[1]):
            told[side] = plain(bins[side], y[side], depth - 1, least, weights)
    return told


@pytest.mark.parametrize("local", [50_000, 400])
@pytest.mark.parametrize("least", [1, 15])
def test_trees_as_one_node_after_the_other(spark, monkeypatch, local, least):
    """Whole trees in one task, and levels over all tasks with subtrees below."""
    monkeypatch.setattr(trees, "LEAST_LOCAL", local)
    monkeypatch.setattr(trees, "MOST_LOCAL", local)
    monkeypatch.setattr(trees, "CELLS", 5_000)
    df, x, y = made(spark)
    weights = np.array([1.0, 2.0, 0.5])
    weighted = df.withColumn("weight", F.element_at(F.array(*map(F.lit, weights.tolist())), F.col("y").cast("int") + 1))
    cuts = [trees.cuts_of(x[:, f]) for f in range(5)]
    bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
    deep = trees.fit_tree(weighted, 3, 7, least, "weight", 1)
    for depth in (0, 2, 4, 7):
        wanted = plain(bins, y, depth, least, weights)
        for model in (deep.cut_off(depth), trees.fit_tree(weighted, 3, depth, least, "weight", 1)):
            got = {r["row_id"]: r["prediction"] for r in model.transform(df).collect()}
            assert [got[i] for i in range(len(y))] == wanted.tolist()


def test_trees_are_as_good_as_sparks(spark):
    df, _, y = made(spark, 8_000, 9)
    held, _, told = made(spark, 4_000, 10)
    for depth, least in ((4, 1), (12, 20)):
        own = models.fit_classifier(models.ModelSpec("DecisionTree", {"max_depth": depth, "min_samples_leaf": least}), df, 3)
        assert isinstance(own, trees.TreeModel)
        theirs = DecisionTreeClassifier(labelCol="y", maxBins=64, maxDepth=depth, minInstancesPerNode=least, seed=1).fit(df)
        right = [m.transform(held).where("prediction = y").count() / len(told) for m in (own, theirs)]
        assert right[0] >= right[1] - 0.01


def test_weights_within_a_class_and_refused_parameters(spark):
    df, _, _ = made(spark, 200)
    uneven = df.withColumn("weight", F.col("row_id") % 3 + 1.0)
    assert not isinstance(models.fit_classifier(models.ModelSpec("DecisionTree", {"max_depth": 2}, "balanced"), uneven, 3), trees.TreeModel)
    with pytest.raises(ValueError, match="max_depth=-1"):
        models.fit_classifier(models.ModelSpec("DecisionTree", {"max_depth": -1}), df, 3)
    with pytest.raises(ValueError, match="no class"):
        trees.fit_tree(df.withColumn("y", F.lit(None).cast("double")), 3, 2, 1, None, 1)


def test_cuts():
    assert trees.cuts_of(np.array([1.0, 3.0, 3.0])).tolist() == [2.0] and trees.cuts_of(np.zeros(9)).tolist() == []
    many = trees.cuts_of(np.arange(6_400.0))
    assert len(many) == 63 and np.diff(np.concatenate([[-0.5], many, [6_399.5]])).tolist() == [100.0] * 64
    heavy = trees.cuts_of(np.concatenate([np.zeros(5_000), np.arange(1, 1_000.0)]))
    assert heavy[0] == 0.5 and len(heavy) < 63


def test_boosting_on_bins_as_on_sparks_trees(spark, monkeypatch):
    """The same raw scores as by Spark's trees where both cut at the same places, and nothing stays cached."""
    g = np.random.default_rng(12)
    x = g.integers(0, 9, size=(900, 3)).astype(float)
    y = ((x[:, 0] > 3).astype(int) + (x[:, 1] * x[:, 2] > 20)).clip(0, 2)
    y = np.where(g.random(900) < 0.05, 1, y)
    df = spark.createDataFrame([(float(v), Vectors.dense(r)) for v, r in zip(y, x)], ["y", "features"]).repartition(3)
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)  # scores are written between stages
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    own = boosting.SoftmaxBoosting(5, 0.3, 3).fit(df, 3)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before
    monkeypatch.setattr(boosting, "WIDEST", 0)
    theirs = boosting.SoftmaxBoosting(5, 0.3, 3).fit(df, 3)

    def raw(model):
        out = np.zeros((900, 3))
        for stage in model.stages:
            for k, tree in enumerate(stage):
                for i, row in enumerate(x):
                    at = 0
                    while tree["feature"][at] >= 0:
                        at = at + 1 if row[tree["feature"][at]] <= tree["threshold"][at] else tree["right"][at]
                    out[i, k] += tree["step"][at]
        return out

    assert np.abs(raw(own) - raw(theirs)).max() < 1e-9


def test_forests_are_as_good_as_sparks_and_load_again(spark, monkeypatch, tmp_path):
    df, _, _ = made(spark, 3_000, 9)
    held, _, told = made(spark, 3_000, 10)
    spec = models.ModelSpec("RandomForest", {"n_estimators": 40, "max_depth": 8, "min_samples_leaf": 2})
    own = models.fit_classifier(spec, df, 3)
    assert isinstance(own, trees.ForestModel)
    theirs = RandomForestClassifier(labelCol="y", maxBins=64, numTrees=40, maxDepth=8, minInstancesPerNode=2, seed=1).fit(df)
    right = [m.transform(held).where("prediction = y").count() / len(told) for m in (own, theirs)]
    assert right[0] >= right[1] - 0.01
    PipelineModel([own]).write().overwrite().save(str(tmp_path / "forest"))
    again = PipelineModel.load(str(tmp_path / "forest")).transform(held).select("row_id", "prediction")
    assert sorted(again.collect()) == sorted(own.transform(held).select("row_id", "prediction").collect())
    monkeypatch.setattr(trees, "FOREST_ROWS", 10)
    assert not isinstance(models.fit_classifier(spec, df, 3), trees.ForestModel)


def test_the_imbalance_query_is_the_whole_stage(spark, sf, monkeypatch):
    """Every model of the stage with its starting parameters, every strategy, all folds."""
    asked = []
    monkeypatch.setattr(catalog_models.ablations, "score_board", lambda df, spec, configs, k, *a, **o: asked.append((k, configs)) or (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        catalog_models.k4(spark, sf)
    k, configs = asked[0]
    assert k == 5 and sorted((c.tags["strategy"], c.model.name) for c in configs) == sorted((s, m) for s in ("none", "class_weight", "smote") for m in ("DecisionTree", "RandomForest"))
    assert all(c.model.params == models.DEFAULTS[c.model.name] for c in configs)
