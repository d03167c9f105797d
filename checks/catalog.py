"""Every registered query with, where SQL can say the same, its second-engine SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql as q
from panelkit.functions import label_tokens
from panelkit.operators import (
    balance, charts, clean, cluster_scores, features, impute, labels, metrics, prep, profile, reshape, sampling,
)
from panelkit.session import tune
from panelkit.sources.panel import PANEL_SPEC as S
from panelkit.sources.panel import derived_panel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return derived_panel(tune(spark), sf)


def dom(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_data(panel(spark, sf), S, "domain", keep_keys=True)


def raw_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_data(panel(spark, sf), S, "none", keep_keys=True)


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Doubles rounded as the SQL does it, without a negative zero."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)]
    small = 0.5 * 10.0**-digits
    return df.withColumns(
        {c: F.when(F.abs(c) < small, F.lit(0.0)).otherwise(F.round(c, digits)) for c in doubles}
    )


def rounded_big(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns(
        {
            c: F.when(F.abs(c) > 1e15, F.round(F.col(c) / 1e20, 2) * 1e20)
            .when(F.abs(c) < 0.00005, F.lit(0.0))
            .otherwise(F.round(c, 4))
            for c in doubles
        }
    )


def rule(column: str = "interest_rate", poor: float = 24, good: float = 6):
    return F.when(F.col(column) >= poor, "Poor").when(F.col(column) < good, "Good").otherwise("Standard")


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return dom(spark, sf).withColumn("predicted", rule())


def board(spark: SparkSession, sf: str, configs: list[dict], k: int = 3, modes: bool = False) -> DataFrame:
    """Rule models scored on folds: the configurations expand per row and shrink to counts before any shuffle."""
    names = [n for n in configs[0] if n not in ("column", "poor", "good")]

    def scored(df: DataFrame, chosen: list[dict]) -> DataFrame:
        folded = sampling.stratified_folds(
            df.select("row_id", "score", *[F.col(c).cast("double").alias(c) for c in ("interest_rate", "num_delayed", "days_past_due")]),
            "row_id", "score", k,
        )
        each = F.array(
            *[
                F.struct(
                    *[F.lit(str(c[n])).alias(n) for n in names],
                    rule(c["column"], c["poor"], c["good"]).alias("predicted"),
                )
                for c in chosen
            ]
        )
        return folded.select("fold", F.col("score").alias("actual"), F.inline(each))

    if modes:
        raw = panel(spark, sf)
        parts = [
            scored(clean.clean_data(raw, S, m, keep_keys=True), [c for c in configs if c["outlier_mode"] == m])
            for m in ("none", "domain", "domain_percentile")
        ]
        rows = reshape.union_all(*parts)
    else:
        rows = scored(dom(spark, sf), configs)
    result = metrics.cross_validated_scores(rows, "actual", "predicted", "fold", names)
    return rounded(result.select(*names, "macro_f1", "macro_f1_std", "macro_recall", "accuracy"))


SPLIT_RULES = [
    {"scaler": s, "encoder": e, "model": "rate_rule", "params": f"poor={p}, good={g}", "column": "interest_rate", "poor": p, "good": g}
    for s, p in (("standard", 22), ("minmax", 24), ("robust", 26))
    for e, g in (("onehot", 5), ("ordinal", 6), ("target", 7))
]
MODE_RULES = [
    {"outlier_mode": m, "model": n, "column": c, "poor": p, "good": g}
    for m in ("none", "domain", "domain_percentile")
    for n, c, p, g in (("rate_rule", "interest_rate", 24, 6), ("delay_rule", "num_delayed", 20, 4))
]
STRATEGY_RULES = [
    {"strategy": s, "model": n, "column": c, "poor": p + shift, "good": g + shift}
    for s, shift in (("none", 0), ("class_weight", -2), ("smote", 2))
    for n, c, p, g in (("rate_rule", "interest_rate", 24, 6), ("delay_rule", "num_delayed", 20, 4))
]
MODEL_RULES = [
    {"model": "rate_rule", "column": "interest_rate", "poor": 24, "good": 6},
    {"model": "delay_rule", "column": "num_delayed", "poor": 20, "good": 4},
    {"model": "due_rule", "column": "days_past_due", "poor": 45, "good": 5},
]
