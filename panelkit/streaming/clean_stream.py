"""The row-wise part of the cleaning on a stream.

Placeholders, numbers, durations, bounds, label flags for a known dictionary
and ratios need one row at a time, so they run unchanged on a streaming
DataFrame. Filling and everything fitted need the whole table and do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from panelkit.operators.clean import clean_data
from panelkit.operators.features import add_ratios
from panelkit.operators.labels import encode_multilabel
from panelkit.spec import PanelSpec


def clean_stream(stream: DataFrame, spec: PanelSpec, labels: list[str] | None = None, bounds: bool = True) -> DataFrame:
    """Cleaned rows with ratios, and label flags when ``labels`` gives the dictionary."""
    cleaned = clean_data(stream, spec, "domain" if bounds else "none", keep_keys=True)
    if labels is not None:
        cleaned, _ = encode_multilabel(cleaned, spec, labels)
    return add_ratios(cleaned, spec)


def stream_to_table(cleaned: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends everything available now to a Parquet table; the checkpoint makes a restart exactly-once."""
    return (
        cleaned.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(path)
    )
