"""Multi-label cells: tokens, dictionary, 0/1 columns, sparse 0/1 vectors."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import label_tokens
from panelkit.operators import dictionary
from panelkit.session import drop_written, written
from panelkit.spec import PanelSpec

MAX_LABELS = 1_000
VOCABULARY_BYTES = 64 << 20  # of all labels together, up to which every task holds them; more stay a table


@dataclass
class LabelTable:
    """More labels than a task can hold: a table (label, place, n) of all labels in sorted order, ``rows`` tokens in all."""

    table: DataFrame
    size: int
    rows: int


def tokenize_labels(df: DataFrame, spec: PanelSpec, output: str = "labels") -> DataFrame:
    """Adds the array of labels in the multi-label cell; no label for a null cell."""
    return df.withColumn(output, label_tokens(F.col(spec.multilabel)))


def label_dictionary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every label that occurs, with the column name it gets."""
    # distinct cells first: tokens are then split once per distinct text, not per row
    cells = df.select(spec.multilabel).distinct()
    labels = cells.select(F.explode(label_tokens(F.col(spec.multilabel))).alias("label")).distinct()
    name = F.concat(F.lit(spec.multilabel_prefix), F.replace("label", F.lit(" "), F.lit("_")))
    return labels.withColumn("column", name)


def fit_labels(df: DataFrame, spec: PanelSpec) -> list[str] | None:
    """Sorted labels, or None when the table has no multi-label column."""
    if spec.multilabel not in df.columns:
        return None
    found = label_dictionary(df, spec).select("label").take(MAX_LABELS + 1)
    if len(found) > MAX_LABELS:
        raise ValueError(f"{spec.multilabel} has more than {MAX_LABELS} labels; it cannot become one column each")
    return sorted(r.label for r in found)


def encode_multilabel(
    df: DataFrame, spec: PanelSpec, labels: list[str] | None = None
) -> tuple[DataFrame, list[str] | None]:
    """Replaces the multi-label column by one 0/1 column per label, and returns the labels."""
    if spec.multilabel not in df.columns:
        return df, None
    labels = fit_labels(df, spec) if labels is None else labels
    tokens = label_tokens(F.col(spec.multilabel))
    tagged = df.withColumn("__labels", tokens)
    flags = {
        spec.multilabel_prefix + label.replace(" ", "_"): F.array_contains("__labels", label).cast("int")
        for label in labels
    }
    return tagged.withColumns(flags).drop("__labels", spec.multilabel), labels


def _labels_and_bytes(df: DataFrame, spec: PanelSpec) -> tuple[DataFrame, str, int]:
    """The written labels, where they are, and how many bytes a list of them takes."""
    found, path = written(label_dictionary(df, spec).select("label"), "labels")
    return found, path, found.agg(F.sum(F.octet_length("label") + 16)).first()[0] or 0


def fit_vocabulary(df: DataFrame, spec: PanelSpec) -> list[str]:
    """All labels, sorted: the places of a label vector. Their bytes are summed before they are brought together."""
    found, path, size = _labels_and_bytes(df, spec)
    try:
        if size > VOCABULARY_BYTES:
            raise ValueError(f"the labels of {spec.multilabel} take {size} bytes, more than {VOCABULARY_BYTES}")
        return sorted(found.toArrow().column(0).to_pylist())
    finally:
        drop_written(df.sparkSession, path)


def label_vectors(df: DataFrame, spec: PanelSpec, vocabulary: list[str] | None = None, output: str = "label_vector") -> tuple[DataFrame, list[str] | LabelTable]:
    """Replaces the multi-label column by a sparse vector of zeros and ones, and returns its places.

    One column for any number of labels. A label that stands twice in a cell counts once, an unknown one not at all; a null or
    empty cell is a vector of zeros. Without any label the vector has one place, which stays zero. Labels of up to
    VOCABULARY_BYTES are a list, and vectors are made without a shuffle; more are a LabelTable, which rows meet in a join.
    """
    if vocabulary is None:
        found, path, size = _labels_and_bytes(df, spec)
        try:
            if size > VOCABULARY_BYTES:
                return _table_vectors(df, spec, output)
            vocabulary = sorted(found.toArrow().column(0).to_pylist())
        finally:
            drop_written(df.sparkSession, path)
    # the model takes no empty vocabulary; no token is empty, so nothing is ever counted at this place
    model = CountVectorizerModel.from_vocabulary(vocabulary or [""], inputCol="__labels", outputCol=output, binary=True)
    tokens = F.coalesce(label_tokens(F.col(spec.multilabel)), F.array().cast("array<string>"))
    return model.transform(df.withColumn("__labels", tokens)).drop("__labels", spec.multilabel), vocabulary


def _table_vectors(df: DataFrame, spec: PanelSpec, output: str) -> tuple[DataFrame, LabelTable]:
    """label_vectors() where no task holds all labels: each row's places meet under the row's number."""
    # a row keeps its number only where it is read again and not made again
    rows, _ = written(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    tokens = rows.select("__row", F.explode(F.array_distinct(label_tokens(F.col(spec.multilabel)))).alias("label"))
    known = dictionary.fit(tokens, "label")
    width = known.size
    if width > 2**31 - 1:
        raise ValueError(f"{spec.multilabel} has {width} labels; a vector has at most {2**31 - 1} places")
    places = known.ordinal(tokens, "place").groupBy("__row").agg(F.sort_array(F.collect_list(F.col("place").cast("int"))).alias("__places"))
    kept = [f for f in df.schema.fields if f.name != spec.multilabel]
    met = rows.join(places, "__row", "left").select(*[F.col(f"`{f.name}`") for f in kept], F.coalesce("__places", F.array().cast("array<int>")).alias("__places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indices = batch.column(batch.num_columns - 1)
            offsets, flat = indices.offsets, indices.values
            # offsets of a batch may begin inside its values
            ones = pa.ListArray.from_arrays(offsets, pa.array(np.ones(len(flat))))
            sparse, size = pa.array(np.zeros(batch.num_rows, np.int8)), pa.array(np.full(batch.num_rows, width, np.int32))
            vectors = pa.StructArray.from_arrays([sparse, size, pa.ListArray.from_arrays(offsets, flat), ones], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], vectors], [*(f.name for f in kept), output])

    vectors = met.mapInArrow(run, T.StructType([*kept, T.StructField(output, VectorUDT())]))
    table = known.table.select(F.col("value").alias("label"), F.col("code").cast("int").alias("place"), "n")
    return vectors, LabelTable(table, width, known.rows)


def vector_labels(df: DataFrame, vector: str, vocabulary: list[str] | LabelTable) -> DataFrame:
    """The way back: one row per row of ``df`` and label in its vector (column ``label``), without the vector."""
    kept = [f for f in df.schema.fields if f.name != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a vector comes as its parts; no Python object is made of it
            places = batch.column(batch.num_columns - 1).field("indices")
            rows = pc.list_parent_indices(places)
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in range(len(kept))), pc.list_flatten(places)], [*(f.name for f in kept), "__place"])

    placed = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{vector}`")).mapInArrow(run, T.StructType([*kept, T.StructField("__place", T.IntegerType())]))
    if isinstance(vocabulary, LabelTable):
        return _named(placed, vocabulary)
    # as many rows as labels, whose bytes label_vectors has checked
    named = df.sparkSession.createDataFrame(list(enumerate(vocabulary)), "__place int, label string")
    return placed.join(F.broadcast(named), "__place").drop("__place")


def _named(placed: DataFrame, labels: LabelTable) -> DataFrame:
    """``placed`` with the label of its place: the most frequent, of which there are at most HOT_SHARE, by broadcast."""
    often: Column = F.col("n") > labels.rows / dictionary.HOT_SHARE
    hot = labels.table.where(often).select(F.col("place").alias("__place"), F.col("label").alias("__hot"))
    met = placed.join(F.broadcast(hot), "__place", "left")
    # rows that have found their label keep out of each other's way in the second join; no place is below 0
    spread = -1 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(4_096)).cast("int")
    cold = labels.table.where(~often).select(F.col("place").alias("__key"), F.col("label").alias("__cold"))
    keyed = met.withColumn("__key", F.when(F.col("__hot").isNotNull(), spread).otherwise(F.col("__place")))
    return keyed.join(cold, "__key", "left").withColumn("label", F.coalesce("__hot", "__cold")).drop("__place", "__key", "__hot", "__cold")
