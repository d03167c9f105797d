"""Seeded pseudo-random order keys that any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(row_id: str, seed: int) -> Column:
    """Hex text that orders rows as if shuffled with ``seed``; equal ids get equal keys.

    A row without an id has no place in the order: it would be in no part of a split, so it is an error.
    """
    missing = F.raise_error(F.lit(f"a row has no {row_id}; give every row an id before it is sampled, split or ranked"))
    text = F.coalesce(F.col(f"`{row_id}`").cast("string"), missing.cast("string"))
    return F.md5(F.concat(text, F.lit(f"|{seed}")).cast("binary"))


def hash_bucket(key: Column, hex_digits: int = 4) -> Column:
    """Order-preserving bucket of a sample key: its leading hex digits.

    The key is uniform, so 16**hex_digits buckets split even one class that
    holds most rows into equal shares.
    """
    return F.substring(key, 1, hex_digits)
