"""Benchmark decontamination: size-partitioned containment search with MinHash sketches, verified exactly.

A test item is tiny beside a document, so their Jaccard similarity says little and a banded sketch of the document would
need thousands of hash functions and still lose pairs. The sketches are therefore taken of the items and sized by
partition: an item of q shingles that is contained to a share of t or more lacks at most (1 - t) q of them, so of its
smallest (1 - t) q + 1 MinHash values at least one is in the document. Partitions hold items whose sizes differ by less than
a factor of two; each has one sketch size. A document that holds a sketch value is a candidate, and the share of the item's
shingles that it holds decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text
from panelkit.llm.hashing import sequence_hashes, word_hashes

SHINGLE = 5
CONTAINED = 0.8
#: Items go to all tasks in blocks of at most so many shingles (8 bytes each); more items mean more scans, not more memory.
BLOCK_SHINGLES = 1_000_000


def text_key(text: bytes) -> int:
    """What Spark's xxhash64 makes of a text."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than five words is one shingle, one without words none."""
    found, owner = sequence_hashes(*word_hashes(texts), SHINGLE, whole=True)
    order = np.argsort(owner, kind="stable")
    parts = np.split(found[order], np.searchsorted(owner[order], np.arange(1, len(texts))))
    return [np.unique(p) for p in parts] if texts else []


def sketches(items: list[np.ndarray], contained: float) -> tuple[np.ndarray, np.ndarray]:
    """(MinHash value, item number) of all items, by value. Hashes are mixed, so the smallest are a random choice."""
    largest: dict[int, int] = {}
    for item in items:
        part = len(item).bit_length()
        largest[part] = max(largest.get(part, 0), len(item))
    size = {part: int(np.floor((1 - contained) * most + 1e-9)) + 1 for part, most in largest.items()}
    values = [item[: size[len(item).bit_length()]] for item in items]
    value = np.concatenate([*values, np.zeros(0, np.uint64)])
    number = np.repeat(np.arange(len(items)), [len(v) for v in values])
    order = np.argsort(value, kind="stable")
    return value[order], number[order]


def contained_items(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, item_id, shared, n_shingles, containment) of every document and item contained in it to `contained` or more.

    Words are lower-cased letters and digits, so case and punctuation do not hide an item. Null and empty texts on either
    side hold nothing; rows that repeat give repeated pairs; an empty table on either side gives no row; other columns are
    ignored. A document's memory is linear in its length.
    """
    return _pairs(docs, items, contained).drop("text_key")


def _pairs(docs: DataFrame, items: DataFrame, contained: float) -> DataFrame:
    """contained_items() with the text_key of the document."""
    own = id_and_text(items, "item_id").withColumnRenamed("doc_id", "item_id")
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = int(total // (2 * BLOCK_SHINGLES)) + 1  # a word and its space take two characters at least
    out = None
    for part in range(parts):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        found = _in_block(docs, [r["item_id"] for r in rows], [r["text"].encode() for r in rows], contained)
        out = found if out is None else out.unionByName(found)
    return out


def _in_block(docs: DataFrame, item_ids: list, texts: list[bytes], contained: float) -> DataFrame:
    items = shingles(texts)
    item_ids, items = [i for i, s in zip(item_ids, items, strict=True) if len(s)], [s for s in items if len(s)]
    value, number = sketches(items, contained)
    seen = np.zeros(1 << 16, bool)
    seen[value & np.uint64(0xFFFF)] = True
    names = ["doc_id", "text_key", "item_id", "shared", "n_shingles", "containment"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw in blocks(batches):
            found, owner = sequence_hashes(*word_hashes(raw), SHINGLE, whole=True)
            maybe = np.flatnonzero(seen[found & np.uint64(0xFFFF)])
            at = np.searchsorted(value, found[maybe])
            hit = at < len(value)
            hit[hit] = value[at[hit]] == found[maybe][hit]
            candidates: dict[int, set[int]] = {}
            for text, place in set(zip(owner[maybe][hit].tolist(), at[hit].tolist(), strict=True)):
                for same in range(place, int(np.searchsorted(value, value[place], "right"))):
                    candidates.setdefault(text, set()).add(int(number[same]))
            rows = []
            for text, numbers in candidates.items():
                held = np.sort(found[owner == text])
                for one in sorted(numbers):
                    item = items[one]
                    spot = np.minimum(np.searchsorted(held, item), len(held) - 1)
                    shared = int((held[spot] == item).sum())
                    # compare whole numbers: shared / size can round either way at the threshold
                    if shared >= contained * len(item) - 1e-9:
                        rows.append((ids[text], text_key(raw[text]), item_ids[one], shared, len(item), shared / len(item)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return id_and_text(docs).mapInArrow(run, "doc_id long, text_key long, item_id long, shared long, n_shingles long, containment double")


def decontaminate(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns. Rows that share an id, and rows without one, are told
    apart by their texts."""
    leaks = _pairs(docs, items, contained).select(F.col("doc_id").alias("__leak"), F.col("text_key").alias("__key")).distinct()
    text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["__leak"]) & (text == leaks["__key"]), "left_anti")
