"""Profile tables: classes, missing cells, dirty values, statistics, categories, correlations."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import numeric_text
from panelkit.operators import ranks
from panelkit.operators.clean import clean_data, coerce_numeric_text
from panelkit.operators.quantiles import exact_quantiles, long_values
from panelkit.sources.sinks import write_report_csv
from panelkit.spec import PanelSpec, numeric_columns, string_columns


def _per_column(totals: DataFrame, rows: list[Column]) -> DataFrame:
    """One aggregated row becomes one row per struct."""
    return totals.select(F.inline(F.array(*rows)))


def _share(count: Column | str, total: Column) -> Column:
    return F.try_divide(F.col(count) if isinstance(count, str) else count, total) * 100


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per class, nulls left out, largest first."""
    labelled = df.where(F.col(label).isNotNull())
    total = labelled.agg(F.count("*")).scalar()
    return (
        labelled.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("count"))
        .withColumn("ratio_pct", _share("count", total))
        .orderBy(F.desc("count"), "class")
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing cells per column that has any, most first. One scan."""
    totals = df.agg(F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("missing_count"),
            _share(c, F.col("__rows")).alias("missing_ratio_pct"),
        )
        for c in df.columns
    ]
    found = _per_column(totals, rows).where("missing_count > 0")
    return found.orderBy(F.desc("missing_count"), "column")


def dirty_value_scan(df: DataFrame, placeholders: Sequence[str]) -> DataFrame:
    """How often each placeholder is a column's whole cell. One scan for all tokens and columns."""
    cells = [(t, c, f"{i}_{j}") for i, t in enumerate(placeholders) for j, c in enumerate(string_columns(df))]
    totals = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(F.col(c) == F.lit(t)).alias(n) for t, c, n in cells]
    )
    rows = [
        F.struct(
            F.lit(t).alias("dirty_value"), F.lit(c).alias("column"), F.col(n).alias("count"),
            _share(n, F.col("__rows")).alias("ratio_pct"),
        )
        for t, c, n in cells
    ]
    return _per_column(totals, rows).where("count > 0")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    columns = list(columns)
    totals = long_values(df, columns).groupBy("c").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    ).collect()
    counts = {((), columns[r["c"]]): r["count"] for r in totals}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], counts=counts).values()
    rows = [
        (columns[r["c"]], r["count"], r["mean"], r["std"], r["min"], *quartiles[(), columns[r["c"]]], r["max"])
        for r in sorted(totals, key=lambda r: r["c"])
    ]
    schema = "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def numeric_describe_raw(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Statistics of the dirty numeric columns as read, before any bound."""
    return describe(coerce_numeric_text(df, spec), spec.present(df, spec.numeric_text))


def numeric_describe_after_cleaning(df: DataFrame, spec: PanelSpec, outlier_mode: str = "domain") -> DataFrame:
    cleaned = clean_data(df, spec, outlier_mode)
    return describe(cleaned, spec.present(cleaned, spec.profile_numeric))


def categorical_distribution(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """Value counts with null kept, as a percent of all rows; the ``top_n`` largest if given."""
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    if top_n:
        ordered = ordered.limit(top_n)
    return ordered.withColumn("ratio_pct", _share("count", total))


def categorical_distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in one pass."""
    total = df.agg(F.count("*")).scalar()
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "value").agg(F.count("*").alias("count"))
        .withColumn("ratio_pct", _share("count", total))
    )


def correlation(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Long correlation matrix over the rows complete for each pair."""
    columns = list(columns)
    if method == "spearman":
        return ranks.spearman(df, columns)
    if method == "kendall":
        return ranks.kendall(df, columns)
    if method != "pearson":
        raise ValueError(f"unknown correlation method: {method}")
    return _pearson(df, columns)


def _pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairs from four small matrices of sums.

    One aggregate per pair would update hundreds of buffers per row. Each task
    instead multiplies its batches as matrices and returns one small set of
    sums; values are taken relative to their column's mean, so that no
    precision is lost to large sums.
    """
    p = len(columns)
    means = {columns[r["c"]]: r["m"] for r in long_values(df, columns).groupBy("c").agg(F.avg("v").alias("m")).collect()}
    centre = np.array([means.get(c) or 0.0 for c in columns])

    def sums(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            there = ~np.isnan(x)
            x = np.where(there, x - centre, 0.0)
            there = there.astype(float)
            total += np.stack([there.T @ there, x.T @ there, x.T @ x, (x * x).T @ there])
        yield pd.DataFrame({"i": np.arange(p * p), **{n: total[k].ravel() for k, n in enumerate("nsuq")}})

    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = values.mapInPandas(sums, "i int, n double, s double, u double, q double")
    found = {r["i"]: r for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in "nsuq"]).collect()}
    rows = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            here, back = found.get(i * p + j), found.get(j * p + i)
            rows.append((a, b, _correlation(here, back) if here else None))
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, correlation double")


def _correlation(here, back) -> float | None:
    n = here["n"]
    if not n:
        return None
    spread = [r["q"] - r["s"] ** 2 / n for r in (here, back)]
    if any(v <= 1e-13 * r["q"] for v, r in zip(spread, (here, back))):
        return None  # constant over the shared rows
    value = (here["u"] - here["s"] * back["s"] / n) / (spread[0] * spread[1]) ** 0.5
    return max(-1.0, min(1.0, value))


def correlation_matrix(
    df: DataFrame, spec: PanelSpec, method: str = "pearson", columns: Sequence[str] | None = None
) -> DataFrame:
    """Correlation of the numeric columns after cleaning to domain bounds."""
    cleaned = clean_data(df, spec, "domain")
    return correlation(cleaned, columns or numeric_columns(cleaned, spec.keys()), method)


def outlier_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Min, median and max before and after cleaning, and the rise in the percent of missing cells."""
    columns = [c for c in spec.profile_numeric if c in df.columns]
    raw = {
        f"raw__{c}": numeric_text(F.col(c)) if c in string_columns(df) else F.col(c).cast("double") for c in columns
    }
    both = clean_data(df.withColumns(raw), spec, "domain")
    sides = [*raw, *columns]
    found = long_values(both, sides).groupBy("c").agg(
        F.count("v").alias("count"), F.count("*").alias("rows"), F.min("v").alias("min"), F.max("v").alias("max")
    ).collect()
    stats = {sides[r["c"]]: r for r in found}
    medians = exact_quantiles(both, sides, [0.5], counts={((), c): r["count"] for c, r in stats.items()}).values()
    rows = []
    for c in columns if stats else []:
        before, after = stats[f"raw__{c}"], stats[c]
        lost = (before["count"] - after["count"]) / after["rows"] * 100
        rows.append(
            (c, before["min"], medians[(), f"raw__{c}"][0], before["max"], after["min"], medians[(), c][0], after["max"], lost)
        )
    schema = "column string, " + ", ".join(
        f"{side}_{name} double" for side in ("raw", "clean") for name in ("min", "median", "max")
    )
    return df.sparkSession.createDataFrame(rows, schema + ", dropped_pct double")


def write_eda_reports(df: DataFrame, spec: PanelSpec, out_dir: str) -> dict[str, str]:
    """All profile tables as CSV under ``out_dir``. The input is read once and kept for all of them."""
    df = df.persist()
    try:
        tables = {
            "target_distribution": target_distribution(df, spec.label),
            "missing_report": missing_report(df),
            "dirty_values": dirty_value_scan(df, spec.placeholders),
            "numeric_describe_raw": numeric_describe_raw(df, spec),
            "numeric_describe_clean": numeric_describe_after_cleaning(df, spec),
            "outlier_summary": outlier_summary(df, spec),
            "correlation_matrix": correlation_matrix(df, spec),
            "categorical_distributions": categorical_distributions(df, spec.present(df, spec.profile_categorical)),
        }
        return {name: write_report_csv(table, f"{out_dir.rstrip('/')}/{name}") for name, table in tables.items()}
    finally:
        df.unpersist()
