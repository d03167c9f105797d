"""What the operators share: the two columns they read, batches as bytes, and the shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches handed to Python are cut into blocks of about so many bytes of text, which bounds a worker's memory.
BLOCK_BYTES = 1 << 20


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id as long and the text with null as empty; every other column is left behind, so none can clash."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8) of consecutive rows, about `limit` bytes at a time; a longer text is a block of its own."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        column = batch.column(1)
        kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
        texts = column.cast(kind)
        sizes = np.cumsum([len(x) for x in (v.as_buffer() for v in texts)]) if len(ids) else np.zeros(0, np.int64)
        start = 0
        while start < len(ids):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            yield ids[start:end], texts.slice(start, end - start).to_pylist()
            start = end


def shared_dir(spark: SparkSession) -> None:
    """Makes checkpoint() usable: the folder the cluster names, else (single-machine sessions only) a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder; later reads survive lost executors and do not repeat the work."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
