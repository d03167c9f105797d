"""Model factory: names and parameters to Spark estimators."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.plans.boosting import SoftmaxBoosting
from panelkit.plans.trees import fit_forest, fit_tree

SEED = 42
DEEPEST = 30  # the deepest tree Spark grows; stands for 'no limit'
NORMAL_FEATURES = 4_096  # the most that Spark's normal equations take
WIDEST, MOST_CLASSES = 1_024, 32  # features and classes of a tree on binned rows; what has more is left to Spark's
TASK_ROWS = 2_000_000  # the most that tasks are put together to
TREE = {"maxBins": 64, "maxMemoryInMB": 1024, "seed": SEED}

# The parameters each model starts from.
DEFAULTS: dict[str, dict[str, Any]] = {
    "LogisticRegression": {"C": 1.0, "max_iter": 2000},
    "DecisionTree": {"max_depth": 15, "min_samples_leaf": 1},
    "RandomForest": {"n_estimators": 200, "max_depth": 20, "min_samples_leaf": 1},
    "GradientBoosting": {"n_estimators": 150, "learning_rate": 0.05, "max_depth": 3},
}


@dataclass(frozen=True)
class ModelSpec:
    """A classifier by name. ``class_weight`` is None, 'balanced' or a weight per class."""

    name: str
    params: dict[str, Any] = field(default_factory=dict)
    class_weight: str | dict | None = None

    def with_params(self, params: dict[str, Any]) -> "ModelSpec":
        cleaned = {k.removeprefix("model__"): v for k, v in params.items()}
        unknown = set(cleaned) - set(DEFAULTS[self.name])
        if unknown:
            raise ValueError(f"{self.name} has no parameter {sorted(unknown)}")
        return replace(self, params={**self.params, **cleaned})

    def weighted(self) -> bool:
        # boosting takes no class weights
        return self.class_weight is not None and self.name != "GradientBoosting"

    def fit(self, train: DataFrame, classes: int):
        """Fits on ``features``, class number ``y`` and, if weighted, ``weight``."""
        return fit_classifier(self, train, classes)


def get_models(class_weight: str | dict | None = None) -> dict[str, ModelSpec]:
    """The four classifiers with their starting parameters."""
    return {name: ModelSpec(name, dict(params), class_weight) for name, params in DEFAULTS.items()}


def _depth(value: int | None) -> int:
    """None is no limit, which the deepest tree stands for; a depth that Spark cannot grow is an error."""
    if value is not None and not 0 <= int(value) <= DEEPEST:
        raise ValueError(f"max_depth={value}: trees have 0 to {DEEPEST} levels")
    return DEEPEST if value is None else int(value)


def tree_levels(spec: ModelSpec) -> int | None:
    """How deep a single tree may grow, None where ``spec`` is no tree or refuses its depth."""
    depth = {**DEFAULTS.get(spec.name, {}), **spec.params}.get("max_depth")
    if spec.name != "DecisionTree" or depth is not None and not 0 <= int(depth) <= DEEPEST:
        return None
    return _depth(depth)


def tree_rows(train: DataFrame) -> DataFrame:
    """The rows in no more tasks than cores, unless a task would get over TASK_ROWS.

    In every level each task hands on a histogram of each node that it has rows of. In deep trees these outweigh the rows, so
    what is shuffled goes by tasks times nodes and grows with the square of the table where tasks follow its size.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(1, cores, -(-train.count() // TASK_ROWS)))


def fit_classifier(spec: ModelSpec, train: DataFrame, classes: int):
    p = {**DEFAULTS[spec.name], **spec.params}
    columns = {"featuresCol": "features", "labelCol": "y"}
    if spec.weighted():
        columns["weightCol"] = "weight"
    if spec.name == "LogisticRegression":
        total = train.agg(F.sum("weight") if spec.weighted() else F.count("*")).first()[0]
        # C weighs the summed loss; Spark weighs the penalty against the mean loss
        return LogisticRegression(
            **columns, family="multinomial", maxIter=p["max_iter"], tol=1e-4, standardization=False,
            elasticNetParam=0.0, regParam=1.0 / (p["C"] * total),
        ).fit(train)
    if spec.name in ("DecisionTree", "RandomForest"):
        depth, first = _depth(p["max_depth"]), train.select("features").first()
        if first is not None and first["features"].size <= WIDEST and classes <= MOST_CLASSES:
            rest = depth, p["min_samples_leaf"], "weight" if spec.weighted() else None, SEED
            found = fit_tree(train, classes, *rest) if spec.name == "DecisionTree" else fit_forest(train, classes, p["n_estimators"], *rest)
            if found is not None:
                return found
    if spec.name in ("DecisionTree", "RandomForest"):
        train = tree_rows(train)
    if spec.name == "DecisionTree":
        return DecisionTreeClassifier(
            **columns, **TREE, maxDepth=_depth(p["max_depth"]), minInstancesPerNode=p["min_samples_leaf"]
        ).fit(train)
    if spec.name == "RandomForest":
        return RandomForestClassifier(
            **columns, **TREE, numTrees=p["n_estimators"], maxDepth=_depth(p["max_depth"]),
            minInstancesPerNode=p["min_samples_leaf"], featureSubsetStrategy="sqrt",
        ).fit(train)
    if spec.name == "GradientBoosting":
        return SoftmaxBoosting(p["n_estimators"], p["learning_rate"], p["max_depth"], SEED).fit(train, classes)
    raise ValueError(f"unknown model: {spec.name}")


def fit_ridge(train: DataFrame, label: str = "y", alpha: float = 1.0):
    """Ridge regression from one pass over the rows: sums of products, then a Cholesky solution on the driver.

    The sums are features squared numbers, so beyond NORMAL_FEATURES an iterative solver takes over. Spark scales the label by
    its deviation (of the population in the first, of a sample in the second) before it applies the penalty.
    """
    stats = train.agg(F.count("*").alias("n"), F.stddev_pop(label).alias("s"), F.stddev_samp(label).alias("t")).first()
    first = train.select("features").first()
    if first is None:
        raise ValueError("no rows to fit")
    common = {"featuresCol": "features", "labelCol": label, "elasticNetParam": 0.0, "standardization": False}
    if first["features"].size <= NORMAL_FEATURES:
        return LinearRegression(**common, solver="normal", regParam=alpha * (stats["s"] or 1.0) / stats["n"]).fit(train)
    return LinearRegression(
        **common, solver="l-bfgs", maxIter=1000, tol=1e-9, regParam=alpha * (stats["t"] or 1.0) / stats["n"]
    ).fit(train)


def fit_boosted_regressor(train: DataFrame, label: str = "y", n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3):
    return GBTRegressor(
        featuresCol="features", labelCol=label, maxIter=n_estimators, stepSize=learning_rate,
        maxDepth=max_depth, **TREE,
    ).fit(train)
