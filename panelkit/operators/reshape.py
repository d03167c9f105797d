"""Sorting, limits, unions, distinct values, pivot and unpivot of report tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Largest first, nulls last; ``ties`` make the order total."""
    return df.orderBy(F.col(column).desc_nulls_last(), *ties)


def top_n(df: DataFrame, column: str, n: int, *ties: str) -> DataFrame:
    """The first ``n`` rows by ``column``: every task keeps n rows, nothing is fully sorted."""
    return sort_desc(df, column, *ties).limit(n)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def pivot(df: DataFrame, index: str, columns: str, values: str, headings: Sequence[str] | None = None) -> DataFrame:
    """One row per ``index``, one column per value of ``columns``."""
    return df.groupBy(index).pivot(columns, list(headings) if headings else None).agg(F.first(values))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per (row, value column)."""
    return df.unpivot(list(ids), list(values), name, value)


def rank_board(board: DataFrame, metric: str = "macro_f1", ties: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank`` by descending metric. A board has one row per configuration, so one window is fine."""
    order = W.orderBy(F.col(metric).desc_nulls_last(), *ties)
    return board.withColumn("rank", F.row_number().over(order)).select("rank", *board.columns)
