"""Class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.spec import MAX_CLASSES


def unweighted(df: DataFrame) -> DataFrame:
    """No balancing: every row counts once."""
    return df.withColumn("weight", F.lit(1.0))


def class_weights(df: DataFrame, label: str) -> dict[object, float]:
    """Balanced weight n / (classes * class rows) per class."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).take(MAX_CLASSES + 1)
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    total = sum(r["n"] for r in rows)
    return {r[label]: total / (len(rows) * r["n"]) for r in rows}


def balanced_weights(df: DataFrame, label: str, weights: dict[object, float] | None = None) -> DataFrame:
    """Adds ``weight`` so that every class has the same total. A projection, with no join."""
    weights = class_weights(df, label) if weights is None else weights
    column = F.lit(None).cast("double")
    for value, weight in weights.items():
        column = F.when(F.col(label) == F.lit(value), F.lit(weight)).otherwise(column)
    return df.withColumn("weight", column)
