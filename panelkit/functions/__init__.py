"""Column expressions. All of them are native Spark expressions; none is a UDF."""

from panelkit.functions.keys import sample_key, hash_bucket
from panelkit.functions.text import (
    blank_placeholders,
    duration_months,
    label_tokens,
    numeric_text,
)

__all__ = [
    "blank_placeholders", "duration_months", "hash_bucket", "label_tokens", "numeric_text", "sample_key",
]
