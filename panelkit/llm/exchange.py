"""Chunks of documents as units of exchange: what a chunk asks of many buckets, and what comes back to it.

A chunk is a few megabytes of consecutive rows, named by a hash of its content. Its questions (keys of text positions) go
to buckets by key; a bucket sees each key at most once per chunk, however often the key stands there, and answers in the
order it was asked. The chunk's text is shuffled once, compressed, to meet the answers. A name that depends on the content
makes a chunk that was built anew from other rows (a source that is not deterministic) an error instead of a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20  # text whose keys meet in one bucket
NO_ID = (1 << 63) - 1  # stands for a null id: larger than every other
SCHEMA = "chunk long, bucket int, kind int, a binary, b binary, c binary"
_NAMES = ["chunk", "bucket", "kind", "a", "b", "c"]
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
TEXT = -1  # the kind of the row that holds a chunk's text


def squeeze(data: bytes) -> bytes:
    """What is shuffled is limited more tightly than processor time, so this is not the fastest level."""
    return zstandard.ZstdCompressor(level=6).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)


def squeeze_numbers(values: np.ndarray) -> bytes:
    """64-bit numbers with their bytes put apart: those that are alike everywhere take next to nothing."""
    return squeeze(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def expand_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(expand(data), np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


@dataclass
class Chunk:
    """Documents `ids` with texts data[offsets[i] : offsets[i + 1]]."""

    ids: np.ndarray
    offsets: np.ndarray
    data: bytes
    name: int = field(init=False)

    def __post_init__(self):
        digest = xxhash.xxh64(self.ids.tobytes())
        digest.update(self.offsets.tobytes())
        digest.update(self.data)
        self.name = digest.intdigest() - (1 << 63)

    @classmethod
    def of(cls, ids: list, texts: list[bytes]) -> Chunk:
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        return cls(np.array([NO_ID if i is None else i for i in ids], np.int64), offsets, b"".join(texts))

    def packed(self) -> tuple:
        return self.name, -1, TEXT, self.ids.tobytes(), self.offsets.tobytes(), squeeze(self.data)

    @classmethod
    def unpacked(cls, row: dict) -> Chunk:
        data = expand(row["c"])
        return cls(np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64), data)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        """The document (by its place in the chunk) that holds each byte position."""
        return np.searchsorted(self.offsets, places, "right") - 1


def chunks(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[Chunk]:
    limit = limit or CHUNK_BYTES
    ids, texts, size = [], [], 0
    for some_ids, some in blocks(batches):
        for one, text in zip(some_ids, some, strict=True):
            if texts and size + len(text) > limit:
                yield Chunk.of(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(one)
            texts.append(text)
            size += len(text)
    if texts:
        yield Chunk.of(ids, texts)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def table(rows: list[tuple]) -> pa.Table:
    if rows:
        return pa.Table.from_batches([batch(rows)])
    return pa.Table.from_arrays([pa.array([], t) for t in _TYPES], names=_NAMES)


def bucket_count(docs: DataFrame, limit: int | None = None) -> int:
    """So many buckets that each holds the keys of about BUCKET_BYTES (or `limit`) of text."""
    size = id_and_text(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(size // (limit or BUCKET_BYTES)) + 1


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of 64-bit keys: equal ranges of their upper half."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of each bucket that sorted keys touch."""
    own = bucket_of(keys, buckets)
    edges = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield int(own[start]), slice(int(start), int(end))


def texts(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """A row with the compressed text of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit):
            yield batch([chunk.packed()])

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def marks(docs: DataFrame, named: DataFrame, kind: int, limit: int | None = None) -> DataFrame:
    """A row of `kind` for every document whose id is among `named` (distinct doc_id): its place in its chunk as the bucket.

    Ids meet in a join, so no list of them reaches the driver or a task; chunks keep the rows in the order they were read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit):
            n = len(chunk.ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk.name)), pa.array(np.arange(n, dtype=np.int32)), pa.array(chunk.ids, mask=chunk.ids == NO_ID)], ["chunk", "bucket", "doc_id"])

    rows = id_and_text(docs).mapInArrow(run, "chunk long, bucket int, doc_id long").where("doc_id IS NOT NULL")
    empty = [F.lit(None).cast("binary").alias(name) for name in "abc"]
    return rows.join(named, "doc_id", "left_semi").select("chunk", "bucket", F.lit(kind).alias("kind"), *empty)


def ask(docs: DataFrame, question: Callable[[Chunk], list[tuple]], limit: int | None = None) -> DataFrame:
    """The rows that `question` makes of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit):
            if rows := question(chunk):
                yield batch(rows)

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def answer(questions: DataFrame, reply: Callable[[list[dict]], list[tuple]]) -> DataFrame:
    """Replies of every bucket and kind of question, each given in an order that does not depend on the shuffle's."""

    def run(group: pa.Table) -> pa.Table:
        return table(reply(sorted(group.to_pylist(), key=lambda row: (row["chunk"], row["a"]))))

    return questions.groupBy("bucket", "kind").applyInArrow(run, SCHEMA)


def meet(docs: DataFrame, answers: DataFrame, use: Callable[[Chunk, dict[int, list[dict]]], pa.Table], schema: str, limit: int | None = None) -> DataFrame:
    """Brings every chunk's text together with its answers: use(chunk, answers by kind in order of bucket)."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = [row for row in rows if row["kind"] == TEXT]
        if not own:
            raise RuntimeError("answers for a chunk that no longer exists: read the documents from a table, or checkpoint them first")
        kinds: dict[int, list[dict]] = {}
        seen = set()
        for row in sorted((r for r in rows if r["kind"] != TEXT), key=lambda r: r["bucket"]):
            # chunks of equal content ask and are answered alike; one of the equal answers is enough
            if (row["kind"], row["bucket"]) not in seen:
                seen.add((row["kind"], row["bucket"]))
                kinds.setdefault(row["kind"], []).append(row)
        return pa.concat_tables([use(Chunk.unpacked(row), kinds) for row in own])

    return texts(docs, limit).unionByName(answers).groupBy("chunk").applyInArrow(run, schema)
