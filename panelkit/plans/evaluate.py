"""Cross-validation, hold-out scoring and grid search."""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any, Callable, Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators import balance, metrics, sampling
from panelkit.operators.features import split_features
from panelkit.operators.prep import WHOLE, FittedPrep, check_names, fit_stats
from panelkit.operators.smote import smote
from panelkit.plans.models import ModelSpec, tree_levels
from panelkit.plans.search import format_params, param_grid
from panelkit.plans.trees import TreeModel
from panelkit.session import drop_written, exists, written
from panelkit.spec import MAX_CLASSES, PanelSpec

METRICS = ("accuracy", "macro_f1", "macro_recall")
#: What a configuration's own fault raises: parameters or rows that a step refuses. Anything else (lost executors, memory, storage,
#: a job that ends) says nothing about the configuration, so it ends the run instead of standing in for a result.
REFUSED = (ValueError, IllegalArgumentException)
#: (confusion counts, columns to score by) -> those columns and ``value``
Scoring = Callable[[DataFrame, list[str]], DataFrame]


@dataclass(frozen=True)
class Config:
    """One pipeline: scaler, encoder, optional SMOTE on training rows, model."""

    model: ModelSpec
    scaler: str = "robust"
    encoder: str = "onehot"
    use_smote: bool = False
    tags: dict[str, Any] = field(default_factory=dict)


def build_pipeline(scaler: str, encoder: str, model: ModelSpec, use_smote: bool = False, /, **tags) -> Config:
    return Config(model, *check_names(scaler, encoder), use_smote, tags)


def label_classes(df: DataFrame, label: str) -> list:
    """All classes, sorted; too many to give each a model output are an error."""
    seen = df.where(F.col(f"`{label}`").isNotNull()).select(F.col(f"`{label}`").alias("c")).distinct().take(MAX_CLASSES + 1)
    if len(seen) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return sorted(r["c"] for r in seen)


def class_number(label: str, classes: Sequence) -> Any:
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1).cast("double").alias("y")


def fit_config(config: Config, train: DataFrame, spec: PanelSpec, classes: Sequence):
    """Fits the model of ``config`` on vectors (row id, y, features)."""
    if config.use_smote:
        # models read their rows many times; the new ones are made once
        train, path = written(smote(train, "y", spec.row_id), "resampled")
        try:
            return fit_config(replace(config, use_smote=False), train, spec, classes)
        finally:
            drop_written(train.sparkSession, path)
    if config.model.weighted():
        given = config.model.class_weight
        by_number = {float(i): given[c] for i, c in enumerate(classes)} if isinstance(given, dict) else None
        train = balance.balanced_weights(train, "y", by_number)
    return config.model.fit(train, len(classes))


def cross_validate(
    df: DataFrame,
    spec: PanelSpec,
    configs: Sequence[Config],
    k: int = 5,
    seed: int = 42,
    group_col: str | None = None,
    parallelism: int = 1,
    scoring: dict[str, Scoring] | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, dict[int, tuple[float, str | None]]]:
    """Scores of every configuration: (config, accuracy, macro F1, macro recall, each with its deviation).

    The preparation depends on scaler and encoder only, so it is fitted once
    for all folds and its vectors are kept while every model that shares them
    is tried. A configuration that a step refuses gets no scores; the second
    result holds its seconds and error text. Any other failure ends the run.
    ``scoring`` adds a column of mean values over the folds for each function,
    which gets confusion counts (config, fold, actual, predicted, n) and the
    columns to score by.

    ``ledger`` names a shared folder that keeps the confusion counts of every finished (configuration, fold). A run that was
    ended finds them there and fits only what is missing. Entries are told apart by configuration, ``k`` and ``seed``, not by
    the rows: a ledger belongs to one table. Failures are not kept.
    """
    spark = df.sparkSession
    numeric, categorical = split_features(df, spec)
    folded, path = written(
        sampling.stratified_folds(df.where(F.col(spec.label).isNotNull()), spec.row_id, spec.label, k, seed, group_col), "folded"
    )
    rows: list[tuple] = []
    notes: dict[int, tuple[float, str | None]] = {i: (0.0, None) for i in range(len(configs))}
    try:
        classes = label_classes(folded, spec.label)
        scalers = {c.scaler for c in configs}
        # class counts per category are only gathered for an encoder that uses them
        by_class = spec.label if any(c.encoder == "target" for c in configs) else None
        stats = fit_stats(folded, numeric, categorical, by_class, k, scalers)
        lock = Lock()

        def score(job):
            pair, fold = job
            sharing = [(i, c) for i, c in enumerate(configs) if (c.scaler, c.encoder) == pair]
            entries = {i: _entry(ledger, c, fold, k, seed, group_col) for i, c in sharing} if ledger else {}
            _score_fold(folded, spec, classes, stats[fold].prep(*pair), fold, sharing, rows, notes, lock, entries)

        pairs = dict.fromkeys((c.scaler, c.encoder) for c in configs)
        # each job keeps one vector table, so parallelism also bounds what is kept at a time
        with ThreadPool(max(1, parallelism)) as pool:
            pool.map(score, [(pair, fold) for pair in pairs for fold in range(k)], chunksize=1)
    finally:
        drop_written(spark, path)
    schema = "config int, fold int, actual double, predicted double, n long"
    failed = {i for i, (_, error) in notes.items() if error}
    # a confusion table per configuration and fold: classes squared rows each
    counts = spark.createDataFrame([r for r in rows if r[0] not in failed], schema)
    scores = metrics.summary_scores(counts, ["config", "fold"])
    summary = metrics.fold_summary(scores, ["config"])
    for name, function in (scoring or {}).items():
        own = function(counts, ["config", "fold"]).groupBy("config").agg(F.avg("value").alias(name))
        summary = summary.join(own, "config", "left")
    return summary, notes


def _first_line(problem: Exception) -> str:
    return str(problem).splitlines()[0] if str(problem) else type(problem).__name__


def _entry(ledger: str, config: Config, fold: int, *folding) -> str:
    """Where a ledger keeps one configuration's counts on one fold."""
    told = repr((config.scaler, config.encoder, config.model.name, sorted(config.model.params.items()), config.model.class_weight, config.use_smote, *folding))
    return f"{ledger.rstrip('/')}/{hashlib.md5(told.encode(), usedforsecurity=False).hexdigest()}-{fold}"


def _nested(sharing: list[tuple[int, Config]]) -> list[list[tuple[int, Config]]]:
    """Groups of configurations whose trees differ in their depth only, the deepest first; all others alone."""
    groups: dict[Any, list[tuple[int, Config]]] = {}
    for index, config in sharing:
        own = replace(config.model, params={k: v for k, v in config.model.params.items() if k != "max_depth"})
        levels = tree_levels(config.model)
        groups.setdefault(index if levels is None else repr((own, config.use_smote)), []).append((index, config))
    return [sorted(g, key=lambda one: -(tree_levels(one[1].model) or 0)) for g in groups.values()]


_COUNTS = "actual double, predicted double, n long, seconds double"


def _score_fold(folded, spec, classes, prep: FittedPrep, fold, sharing, rows, notes, lock, entries: dict[int, str]) -> None:
    spark = folded.sparkSession
    done = [i for i, path in entries.items() if exists(spark, f"{path}/_SUCCESS")]
    for index in done:
        kept = spark.read.schema(_COUNTS).parquet(entries[index]).collect()
        with lock:
            rows.extend((index, fold, r["actual"], r["predicted"], r["n"]) for r in kept)
            notes[index] = (notes[index][0] + (kept[0]["seconds"] if kept else 0.0), notes[index][1])
    sharing = [(i, c) for i, c in sharing if i not in done]
    if not sharing:
        return
    test = F.col("fold") == fold
    inner = F.when(test, F.lit(WHOLE)).otherwise(F.col("inner_fold")) if prep.encoder == "target" else None
    base = folded.withColumn("y", class_number(spec.label, classes))
    try:
        vectors, path = written(prep.vectors(base, [spec.row_id, "y", "fold"], inner=inner), "vectors")
    except REFUSED as problem:  # a preparation that is refused ends the configurations that share it, no others
        with lock:
            for index, _ in sharing:
                notes[index] = (notes[index][0], notes[index][1] or _first_line(problem))
        return
    train, held_out = vectors.where(~test), vectors.where(test)
    try:
        for group in _nested([(i, c) for i, c in sharing if not notes[i][1]]):
            model, fitting, error = None, 0.0, None
            for index, config in group:
                started, counts = time.time(), []
                try:
                    own = model.cut_off(tree_levels(config.model)) if isinstance(model, TreeModel) else None
                    if own is None and not error:
                        own = model = fit_config(config, train, spec, classes)
                        # a group shares the time of its fit
                        fitting = (time.time() - started) / (len(group) if isinstance(model, TreeModel) else 1)
                        started = time.time()
                    if own is not None:
                        counts = metrics.confusion_counts(own.transform(held_out), "y", "prediction").collect()
                except REFUSED as problem:  # one refused configuration must not end the others
                    error = _first_line(problem)
                took = time.time() - started + fitting
                if index in entries and not error:
                    kept = [(r["actual"], r["predicted"], r["n"], took) for r in counts]
                    spark.createDataFrame(kept, _COUNTS).coalesce(1).write.mode("overwrite").parquet(entries[index])
                with lock:
                    rows.extend((index, fold, r["actual"], r["predicted"], r["n"]) for r in counts)
                    seconds, earlier = notes[index]
                    notes[index] = (seconds + took, earlier or error)
    finally:
        drop_written(spark, path)


def score_board(df: DataFrame, spec: PanelSpec, configs: Sequence[Config], k: int = 5, strict: bool = False, **options) -> DataFrame:
    """One row per configuration: its tags, scores, seconds and error (scores are null after an error).

    ``strict`` is for boards that do not hand on the error: a refused configuration raises.
    """
    scores, notes = cross_validate(df, spec, configs, k, **options)
    refused = [f"{configs[i].tags}: {error}" for i, (_, error) in notes.items() if error]
    if strict and refused:
        raise ValueError(f"{len(refused)} of {len(configs)} configurations have no scores; {'; '.join(refused)}")
    tags = list(configs[0].tags) if configs else []
    schema = T.StructType().add("config", T.IntegerType())
    for tag in tags:
        schema = schema.add(tag, T.StringType())
    schema = schema.add("fit_seconds", T.DoubleType()).add("error", T.StringType())
    described = [(i, *(str(c.tags[t]) for t in tags), float(notes[i][0]), notes[i][1]) for i, c in enumerate(configs)]
    known = df.sparkSession.createDataFrame(described, schema)
    return known.join(scores, "config", "left").select(
        "config", *tags, "macro_f1", "macro_f1_std", "macro_recall", "accuracy", *(options.get("scoring") or {}), "fit_seconds", "error"
    )


@dataclass
class Holdout:
    """Scores of a fitted pipeline on held-out rows."""

    predictions: DataFrame
    report: DataFrame
    summary: DataFrame
    pipeline: PipelineModel
    model: Any


def fit_pipeline(train: DataFrame, spec: PanelSpec, config: Config):
    """Fits preparation and model on ``train``: (preparation, model, classes)."""
    numeric, categorical = split_features(train.drop("is_test"), spec)
    if config.encoder == "target":
        train = sampling.stratified_folds(train, spec.row_id, spec.label, 5)
        train = train.withColumn("inner_fold", F.col("fold")).drop("fold")
    else:
        train = train.withColumn("inner_fold", F.lit(0))
    by_class = spec.label if config.encoder == "target" else None
    stats = fit_stats(train, numeric, categorical, by_class, scalers=(config.scaler,))[WHOLE]
    prep = stats.prep(config.scaler, config.encoder)
    classes = label_classes(train, spec.label)
    inner = F.col("inner_fold") if config.encoder == "target" else None
    vectors = prep.vectors(train.withColumn("y", class_number(spec.label, classes)), [spec.row_id, "y"], inner=inner)
    # models read their rows many times; written out they take no executor's memory
    vectors, path = written(vectors, "vectors")
    try:
        return prep, fit_config(config, vectors, spec, classes), classes
    finally:
        drop_written(train.sparkSession, path)


def saveable_pipeline(prep: FittedPrep, model, classes: Sequence) -> PipelineModel:
    """Preparation, model and class names as one Spark pipeline, which saves and loads as a whole."""
    names = ", ".join("'" + str(c).replace("'", "\\'") + "'" for c in classes)
    name = SQLTransformer(statement=f"SELECT *, element_at(array({names}), CAST(prediction AS INT) + 1) AS predicted FROM __THIS__")
    return PipelineModel([*prep.stages(), model, name])


def evaluate_holdout(df: DataFrame, spec: PanelSpec, config: Config, fraction: float = 0.2, seed: int = 42) -> Holdout:
    """Fits on the training part of a stratified split and scores the rest."""
    split = sampling.stratified_split(df.where(F.col(spec.label).isNotNull()), spec.row_id, spec.label, fraction, seed)
    train, test = split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")
    prep, model, classes = fit_pipeline(train, spec, config)
    vectors = prep.vectors(test.withColumn("y", class_number(spec.label, classes)), [spec.row_id, spec.label, "y"])
    named = F.get(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int"))
    predictions = model.transform(vectors).select(spec.row_id, spec.label, named.alias("predicted"))
    counts = metrics.confusion_counts(predictions, spec.label, "predicted")
    return Holdout(
        predictions, metrics.classification_report(predictions, spec.label, "predicted"),
        metrics.summary_scores(counts), saveable_pipeline(prep, model, classes), model,
    )


def tune_with_gridsearch(
    df: DataFrame, spec: PanelSpec, config: Config, grid: dict[str, list], k: int = 5, metric: str = "macro_f1", **options
):
    """Tries every combination of ``grid``; returns (board, best parameters, best score, configuration refit on all rows)."""
    combos = list(param_grid(grid))
    configs = [
        Config(config.model.with_params(p), config.scaler, config.encoder, config.use_smote, {"params": format_params(p)})
        for p in combos
    ]
    board = score_board(df, spec, configs, k, **options)
    best = board.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), "config").first()
    if best is None:
        raise ValueError("every configuration failed")
    chosen = configs[best["config"]]
    refit = fit_pipeline(df.where(F.col(spec.label).isNotNull()), spec, chosen)
    return board, combos[best["config"]], best[metric], (chosen, refit)
