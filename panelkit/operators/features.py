"""Ratio features, feature lists, and the whole preparation chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.text import finite
from panelkit.operators.clean import clean_data
from panelkit.operators.impute import group_impute
from panelkit.operators.labels import encode_multilabel, fit_labels
from panelkit.spec import PanelSpec, numeric_columns, string_columns


def add_ratios(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``numerator / (denominator + 1)`` for every ratio whose two columns exist.

    A denominator of exactly -1 gives null, never an infinity.
    """
    ratios = {
        r.name: finite(F.try_divide(F.col(r.numerator).cast("double"), F.col(r.denominator).cast("double") + 1))
        for r in spec.ratios
        if {r.numerator, r.denominator} <= set(df.columns)
    }
    return df.withColumns(ratios) if ratios else df


def split_features(df: DataFrame, spec: PanelSpec, target: str | None = None) -> tuple[list[str], list[str]]:
    """Names of the numeric and the categorical feature columns, target and keys left out."""
    skip = (*spec.keys(), spec.label if target is None else target)
    return numeric_columns(df, skip), string_columns(df, skip)


def feature_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per feature column: its kind and how many cells are filled."""
    numeric, categorical = split_features(df, spec)
    kinds = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    counts = df.agg(*[F.count(c).alias(c) for c, _ in kinds])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(c).alias("filled")) for c, kind in kinds
    ]
    return counts.select(F.inline(F.array(*rows)))


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keeps rows in which every named column has a value."""
    return df.na.drop(subset=columns)


def prepare(
    raw: DataFrame, spec: PanelSpec, outlier_mode: str = "domain", labels: list[str] | None = None
) -> DataFrame:
    """Clean, fill within the entity, drop the entity key, expand labels, add ratios.

    The row and order keys stay, because splits need a stable order; they are
    never features.
    """
    df = clean_data(raw, spec, outlier_mode, keep_keys=True)
    if labels is None and spec.multilabel in df.columns:
        # filling only copies cells, so the dictionary can be read before the shuffle
        labels = fit_labels(df, spec)
    df = group_impute(df, spec).drop(spec.entity)
    df, _ = encode_multilabel(df, spec, labels)
    return add_ratios(df, spec)

