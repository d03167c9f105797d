"""Reading panel tables from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that count as missing when a CSV is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_panel_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_tokens: tuple[str, ...] = NA_TOKENS,
) -> DataFrame:
    """A CSV with a header, typed by ``schema``; every NA token becomes null.

    Cells are read as text in one pass without inference, so the file stays
    splittable and a bad number costs a null cell rather than the row. Only
    the columns a query uses are parsed.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    columns = []
    for f in schema.fields:
        cell = F.when(~F.col(f.name).isin(*na_tokens), F.col(f.name))
        if not isinstance(f.dataType, T.StringType):
            cell = F.trim(cell).try_cast(f.dataType)
        columns.append(cell.alias(f.name))
    return raw.select(*columns)
