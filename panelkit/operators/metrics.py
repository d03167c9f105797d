"""Scores computed from confusion counts, so predictions are read once and shrink map-side."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.spec import MAX_CLASSES



def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (by, actual, predicted); only pairs that occur."""
    return df.groupBy(*by, F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long confusion matrix with its zero cells, over the sorted labels of either side."""
    counts = confusion_counts(df, label, prediction)
    seen = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct().take(MAX_CLASSES + 1)
    if len(seen) > MAX_CLASSES:
        raise ValueError(f"{label} and {prediction} have more than {MAX_CLASSES} classes; a confusion matrix would not be small")
    labels = sorted(r["c"] for r in seen)
    kind = df.schema[label].dataType
    schema = T.StructType().add("actual", kind).add("predicted", kind)
    cells = df.sparkSession.createDataFrame([(a, p) for a in labels for p in labels], schema)
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("count")
    )


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, from confusion counts; an empty denominator scores 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ),
    )
    totals = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])

    def share(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return totals.select(
        *by, "class",
        share(F.col("tp"), F.col("predicted")).alias("precision"),
        share(F.col("tp"), F.col("support")).alias("recall"),
        share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support", "tp",
    )


def summary_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 and macro recall per group of confusion counts."""
    return class_scores(counts, by).groupBy(*by).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1_score").alias("macro_f1"),
        F.avg("recall").alias("macro_recall"),
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class scores, accuracy, and macro and weighted averages as (class, metric, value)."""
    scores = class_scores(confusion_counts(df, label, prediction))
    metrics = ["precision", "recall", "f1_score"]
    weight = F.sum("support")
    # a rollup of the few class rows gives the averages in the same pass
    rolled = scores.rollup("class").agg(
        *[F.avg(m).alias(m) for m in metrics],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), weight).alias(f"w_{m}") for m in metrics],
        weight.cast("double").alias("support"),
        F.try_divide(F.sum("tp"), weight).alias("accuracy"),
        F.grouping("class").alias("overall"),
    )

    def rows(name, prefix=""):
        values = [F.struct(name.alias("class"), F.lit(m).alias("metric"), F.col(prefix + m).alias("value")) for m in metrics]
        return [*values, F.struct(name.alias("class"), F.lit("support").alias("metric"), F.col("support").alias("value"))]

    accuracy = F.struct(F.lit("accuracy").alias("class"), F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    overall = F.array(accuracy, *rows(F.lit("macro avg")), *rows(F.lit("weighted avg"), "w_"))
    per_class = F.array(*rows(F.col("class").cast("string")))
    return rolled.select(F.inline(F.when(F.col("overall") == 1, overall).otherwise(per_class)))


def fold_summary(fold_scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of each metric over folds."""
    return fold_scores.groupBy(*by).agg(
        F.avg("macro_f1").alias("macro_f1"),
        F.stddev_pop("macro_f1").alias("macro_f1_std"),
        F.avg("macro_recall").alias("macro_recall"),
        F.stddev_pop("macro_recall").alias("macro_recall_std"),
        F.avg("accuracy").alias("accuracy"),
        F.stddev_pop("accuracy").alias("accuracy_std"),
    )


def cross_validated_scores(predicted: DataFrame, label: str, prediction: str, fold: str, by: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold predictions of many configurations to one summary row each, in one query."""
    counts = confusion_counts(predicted, label, prediction, [*by, fold])
    return fold_summary(summary_scores(counts, [*by, fold]), by)


def regression_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2 and mean absolute error in one pass."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    residual = F.sum((y - p) * (y - p))
    # var_pop is computed around a running mean, unlike a difference of large sums
    return df.agg(
        (1 - F.try_divide(residual, F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(F.abs(y - p)).alias("mae"),
    )
