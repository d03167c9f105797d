"""Cleaning: placeholders, dirty numbers, durations, identifiers, bounds, percentile trim.

Each step is one projection, so the chain collapses into a single Project over the scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import text
from panelkit.operators.quantiles import exact_quantiles
from panelkit.spec import OUTLIER_MODES, PanelSpec, numeric_columns, string_columns


def placeholders_to_null(df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-cell placeholder tokens become null in every text column."""
    columns = string_columns(df) if columns is None else columns
    return df.withColumns({c: text.blank_placeholders(F.col(c), spec.placeholders) for c in columns})


def coerce_numeric_text(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Dirty numeric text columns become doubles."""
    columns = [c for c in spec.numeric_text if c in string_columns(df)]
    return df.withColumns({c: text.numeric_text(F.col(c)) for c in columns})


def parse_duration(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The duration text column is replaced by its number of months."""
    if spec.duration not in df.columns:
        return df
    return df.withColumn(spec.duration_months, text.duration_months(F.col(spec.duration))).drop(spec.duration)


def drop_identifiers(df: DataFrame, spec: PanelSpec, keep_keys: bool = False) -> DataFrame:
    """Identifier columns go; the entity, row and order keys stay only with ``keep_keys``."""
    keys = () if keep_keys else spec.keys()
    return df.drop(*spec.present(df, (*spec.identifiers, *keys)))


def apply_bounds(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Values outside an inclusive two-sided range become null."""
    columns = spec.present(df, spec.bounds)
    return df.withColumns(
        {c: F.when(F.col(c).between(*spec.bounds[c]), F.col(c).cast("double")) for c in columns}
    )


def apply_lower_bounds(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Values under a lower limit become null."""
    columns = spec.present(df, spec.lower_only)
    return df.withColumns(
        {c: F.when(F.col(c) >= spec.lower_only[c], F.col(c).cast("double")) for c in columns}
    )


def trim_percentiles(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Values strictly outside the lower and upper percentile of their column become null.

    The limits are two numbers per column, found first; the trim is then a projection.
    """
    lower, upper = spec.trim
    columns = numeric_columns(df, exclude=spec.keys())
    limits = exact_quantiles(df, columns, [lower, upper]).values()
    trimmed = {}
    for c in columns:
        lo, hi = limits[(), c]
        if lo is not None:
            trimmed[c] = F.when(F.col(c).between(lo, hi), F.col(c))
    return df.withColumns(trimmed) if trimmed else df


#: Month names by number.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
)


def number_months(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds the first order column as the number of the month name, where the table has only the name; other text has none."""
    if not spec.order or spec.order[0] in df.columns or spec.month_name not in df.columns:
        return df
    at = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(F.trim(F.col(f"`{spec.month_name}`"))))
    return df.withColumn(spec.order[0], F.when(at > 0, at).cast("int"))


def clean_data(
    df: DataFrame, spec: PanelSpec, outlier_mode: str = "domain", keep_keys: bool = False
) -> DataFrame:
    """Placeholders, numbers, durations, identifiers, then outliers as ``outlier_mode`` says."""
    if outlier_mode not in OUTLIER_MODES:
        raise ValueError(f"unknown outlier_mode: {outlier_mode}")
    df = number_months(df, spec)
    df = placeholders_to_null(df, spec)
    df = coerce_numeric_text(df, spec)
    df = parse_duration(df, spec)
    df = drop_identifiers(df, spec, keep_keys)
    if outlier_mode != "none":
        df = apply_lower_bounds(apply_bounds(df, spec), spec)
    if outlier_mode == "domain_percentile":
        df = trim_percentiles(df, spec)
    return df
