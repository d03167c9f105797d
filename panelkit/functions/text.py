"""Cleaning expressions for dirty text cells."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\x0b"


def finite(col: Column) -> Column:
    """Null instead of NaN or an infinity, so that nulls are the only missing value."""
    # NaN sorts above infinity, so it fails this test too
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def blank_placeholders(col: Column, tokens: Sequence[str]) -> Column:
    """Null where the whole cell is one of ``tokens``."""
    return F.when(~col.isin(*tokens), col) if tokens else col


def numeric_text(col: Column) -> Column:
    """Number in a dirty text cell: every underscore goes, what is still no number is null.

    A cast alone would also take '1d', '2f' or '0x1p3', so these letters are
    made unreadable in the same pass that deletes the underscores.
    """
    return finite(F.translate(col, "dDfFxX_", "zzzzzz").try_cast("double"))


def duration_months(col: Column) -> Column:
    """Months in '<y> Years and <m> Months'.

    A text that names neither unit counts 0 months; a named unit without a
    whole number in its place makes the cell null.
    """
    years = F.substring_index(col, " Years", 1).try_cast("int")
    months = F.substring_index(F.substring_index(col, "and ", -1), " Months", 1).try_cast("int")
    found = (
        F.when(F.contains(col, F.lit("Years")), years).otherwise(0) * 12
        + F.when(F.contains(col, F.lit("Months")), months).otherwise(0)
    )
    return F.when(col.isNotNull(), found)


def label_tokens(col: Column) -> Column:
    """Labels in a comma-separated cell; the joining word 'and ' is removed wherever it stands."""
    parts = F.transform(F.split(col, ","), lambda p: F.replace(F.btrim(p, F.lit(BLANKS)), F.lit("and "), F.lit("")))
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))
