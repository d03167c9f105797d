"""The tables behind the charts: histograms, box statistics, bars, pivots."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions import numeric_text
from panelkit.operators import metrics, reshape
from panelkit.operators.clean import clean_data
from panelkit.operators.profile import correlation_matrix, target_distribution
from panelkit.operators.quantiles import exact_quantiles, with_limits
from panelkit.session import written
from panelkit.spec import OUTLIER_MODES, PanelSpec, string_columns

STRATEGY_ORDER = ("none", "class_weight", "smote")


def _position(column: str, order: Sequence[str]):
    """0-based place in ``order``; null for values outside it."""
    return F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), F.col(column)), F.lit(0)) - 1


def target_bars(df: DataFrame, label: str) -> DataFrame:
    """Class bars, tallest first, with their text."""
    bars = target_distribution(df, label)
    text = F.concat(F.col("count").cast("string"), F.lit(" ("), F.format_number("ratio_pct", 1), F.lit("%)"))
    return bars.withColumn("text", text)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between each column's minimum and maximum; a constant column is one bin."""
    ends = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    cells = []
    for c in columns:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if lo is None:
            continue
        width = (hi - lo) / bins
        x = F.col(c).cast("double")
        bin_ = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width else F.lit(0)
        bin_ = bin_.cast("int")
        start = F.lit(lo) + bin_ * F.lit(width)
        cells.append(
            F.when(x.isNotNull(), F.struct(F.lit(c).alias("column"), bin_.alias("bin"), start.alias("bin_start")))
        )
    return (
        df.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("column", "bin", "bin_start").agg(F.count("*").alias("count"))
    )


def numeric_histograms(df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None, bins: int = 50) -> DataFrame:
    cleaned = clean_data(df, spec, "domain")
    return histogram(cleaned, columns or spec.present(cleaned, spec.profile_numeric), bins)


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 interquartile ranges) and the outliers beyond them."""
    columns, by = list(columns), tuple(by)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by).values()
    limits = {}
    for (group, c), (q1, median, q3) in quartiles.items():
        if q1 is not None:
            limits[group, c, 0.0] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
            limits[group, c, 1.0] = (q1, q3)
            limits[group, c, 2.0] = (median, median)
    data = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=list(by))
    limited, pairs = with_limits(data, by, limits)
    at = {pair: i for i, pair in enumerate(pairs)}
    shown = [c for c in columns if (c, 0.0) in at]
    aggregates = []
    for c in shown:
        fence, box, mid = at[c, 0.0], at[c, 1.0], at[c, 2.0]
        within = F.col(c).between(F.col(f"lo{fence}"), F.col(f"hi{fence}"))
        aggregates += [
            F.max(f"lo{box}").alias(f"q1_{c}"), F.max(f"lo{mid}").alias(f"median_{c}"), F.max(f"hi{box}").alias(f"q3_{c}"),
            F.min(F.when(within, F.col(c))).alias(f"low_{c}"), F.max(F.when(within, F.col(c))).alias(f"high_{c}"),
            F.count_if(~within).alias(f"out_{c}"),
        ]
    totals = limited.groupBy(*by).agg(*aggregates)
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"q1_{c}").alias("q1"), F.col(f"median_{c}").alias("median"),
            F.col(f"q3_{c}").alias("q3"), F.col(f"low_{c}").alias("whisker_low"),
            F.col(f"high_{c}").alias("whisker_high"), F.col(f"out_{c}").alias("outliers"),
        )
        for c in shown
    ]
    return totals.select(*by, F.inline(F.array(*rows)))


def box_before_after(df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Box statistics of every numeric column as read and after cleaning, from one input."""
    columns = list(columns or [c for c in spec.profile_numeric if c in df.columns])
    raw = {f"raw__{c}": numeric_text(F.col(c)) if c in string_columns(df) else F.col(c).cast("double") for c in columns}
    both = clean_data(df.withColumns(raw), spec, "domain")
    stats = box_stats(both, [*raw, *columns])
    before = F.startswith(F.col("column"), F.lit("raw__"))
    return stats.withColumn("stage", F.when(before, "before").otherwise("after")).withColumn(
        "column", F.regexp_replace("column", "^raw__", "")
    )


def box_by_target(df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Box statistics per class, with the class's place on the axis."""
    cleaned = clean_data(df, spec, "domain")
    stats = box_stats(cleaned, columns or spec.present(cleaned, spec.key_features), [spec.label])
    return stats.withColumn("position", _position(spec.label, spec.label_order))


def correlation_heatmap(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Pearson matrix with the two-digit annotation of each cell."""
    return correlation_matrix(df, spec).withColumn("annotation", F.round("correlation", 2))


def category_bars(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bars per category of the uncleaned columns, nulls left out, tallest first."""
    cells = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for c in columns
    ]
    counts = (
        df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("column", "value").agg(F.count("*").alias("count"))
    )
    # ranges of the bars' order are ranked by themselves, so a column of many categories is no single task
    dealt, _ = written(
        counts.repartitionByRange("column", F.desc("count"), "value").withColumn("__range", F.spark_partition_id()), "bars"
    )
    earlier = W.partitionBy("column").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    # one row per range and column
    sizes = dealt.groupBy("column", "__range").agg(F.count("*").alias("__n"))
    offsets = sizes.select("column", "__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    order = W.partitionBy("column", "__range").orderBy(F.desc("count"), "value")
    ranked = dealt.withColumn("__place", F.row_number().over(order)).join(F.broadcast(offsets), ["column", "__range"])
    return ranked.select("column", "value", "count", (F.col("__before") + F.col("__place")).cast("int").alias("position"))


def outlier_bars(board: DataFrame) -> DataFrame:
    """Bars of an outlier ablation in the fixed order of its modes."""
    return board.select("outlier_mode", "model", "macro_f1", _position("outlier_mode", OUTLIER_MODES).alias("position"))


def imbalance_bars(board: DataFrame) -> DataFrame:
    """Bars of an imbalance ablation, one per metric."""
    long = reshape.melt(board, ["strategy", "model"], ["macro_f1", "macro_recall"], "metric", "value")
    return long.withColumn("position", _position("strategy", STRATEGY_ORDER))


def scaler_encoder_pivot(board: DataFrame, encoders: Sequence[str] | None = None) -> DataFrame:
    return reshape.pivot(board, "scaler", "encoder", "macro_f1", encoders)


def model_bars(board: DataFrame, target: float = 0.75) -> DataFrame:
    """Model bars with error limits, best first, and whether the target is met."""
    return board.select(
        "model", "macro_f1", "macro_f1_std",
        (F.col("macro_f1") - F.col("macro_f1_std")).alias("low"),
        (F.col("macro_f1") + F.col("macro_f1_std")).alias("high"),
        (F.col("macro_f1") >= target).alias("meets_target"),
    ).orderBy(F.desc("macro_f1"), "model")


def per_class_bars(df: DataFrame, label: str, prediction: str, recall_target: float = 0.70) -> DataFrame:
    """Precision, recall and F1 per class, long, with whether the recall target is met."""
    scores = metrics.class_scores(metrics.confusion_counts(df, label, prediction))
    long = reshape.melt(scores, ["class"], ["precision", "recall", "f1_score"], "metric", "value")
    met = F.when(F.col("metric") == "recall", F.col("value") >= recall_target)
    return long.withColumn("meets_target", met)


def sweep_bars(top: DataFrame) -> DataFrame:
    """Bars of the best configurations with their text label."""
    label = F.concat(
        F.lit("#"), F.col("rank").cast("string"), F.lit(" "), F.col("model"), F.lit(" | "),
        F.col("scaler"), F.lit("+"), F.col("encoder"), F.lit("\n"), F.col("params"),
    )
    return top.select("rank", label.alias("label"), "macro_f1", "macro_f1_std")
