"""Sequence packing as a cutting-stock problem solved by column generation.

A document longer than a sequence is cut into full pieces and a rest. Piece lengths are counted in classes of `STEP`
tokens, so the problem has at most CAPACITY / STEP rows whatever the input: a linear program over patterns (how many
pieces of each class share a sequence), priced by a knapsack over the capacity. Patterns are rounded down, the few pieces
left over are filled greedily, and the pieces, ranked inside their class, are dealt to the patterns by arithmetic.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text, saved

CAPACITY = 4096
END_ID = 2
STEP = 16  # tokens; a piece takes its length rounded up to this in a pattern, so padding is about half of it a piece
CLASSES = CAPACITY // STEP
BUCKET_ROWS = 100_000  # pieces of one class that are ranked together
CACHED_WORDS = 1_000_000  # words whose ids a worker remembers (about 200 bytes each), and at most as many older ones
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: A comma or full stop that ends a word without following an ASCII letter or digit, or a Latin-1 letter.
_SIGN_ALONE = re.compile(rb"(?<![a-z0-9])(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])[.,](?= )")
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


class WordTokenizer:
    """Ids of whole texts. The vocabulary's rules never join characters across white space, so words are encoded once.

    The rules make every letter small and take a sign after a letter or digit for itself, so capitals are made small and
    such signs split off beforehand; texts where that could matter (special tokens, signs that follow signs) are left as
    they are.
    """

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def words(self, text: bytes) -> list[bytes]:
        if b"<|" in text:
            return text.split()
        text = text.translate(_LOWER)
        if not _SIGN_ALONE.search(text):
            text = text.replace(b", ", b" , ").replace(b". ", b" . ")
        return text.split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers, the end id last."""
        split = [self.words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for word in set(itertools.chain.from_iterable(split)):
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    known[word] = ids
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            found = self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            for word, encoding in zip(part, found, strict=True):
                known[word] = np.array(encoding.ids, "<u4").tobytes()
        end = END_ID.to_bytes(4, "little")
        return [b"".join(map(known.__getitem__, words)) + end for words in split]


@functools.cache
def _tokenizer(path: str | None) -> WordTokenizer:
    """One for all tasks of a worker."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): documents cut into full sequences and a rest, without positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        encoder = _tokenizer(tokenizer)
        size = 4 * CAPACITY
        for ids, texts in blocks(batches):
            rows = [
                (doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(tokens) // 4)
                for doc_id, tokens in zip(ids, encoder.encode(texts), strict=True)
                for at in range(0, len(tokens), size)
                for part in (tokens[at : at + size],)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return id_and_text(docs).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def _best_pattern(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern and its counts by item."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(size, room, "right")  # sizes ascend
        if fits:
            worth = best[room - size[:fits]] + value[:fits]
            at = int(worth.argmax())
            best[room], took[room] = worth[at], at
        if best[room - 1] > best[room]:
            best[room], took[room] = best[room - 1], -1
    counts, room = np.zeros(len(size), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            counts[took[room]] += 1
            room -= int(size[took[room]])
    return float(best[capacity]), counts


def _fullest(left: np.ndarray, size: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of the fullest sequence that holds the largest piece left; among equally full ones, of large pieces."""
    largest = int(np.flatnonzero(left)[-1])
    counts = np.zeros(len(size), np.int64)
    counts[largest] = 1
    room = capacity - int(size[largest])
    # by[t]: the class whose piece made the sum t reachable first; classes come from the largest down
    by = [-1] * (room + 1)
    by[0] = len(size)
    for at in range(largest, -1, -1):
        most, step = int(left[at]) - int(at == largest), int(size[at])
        if most <= 0 or step > room:
            continue
        took = [0] * (room + 1)
        for total in range(step, room + 1):
            if by[total] < 0 <= by[total - step] and took[total - step] < most:
                by[total], took[total] = at, took[total - step] + 1
        if by[room] >= 0:
            break
    total = max(t for t in range(room + 1) if by[t] >= 0)
    while total:
        counts[by[total]] += 1
        total -= int(size[by[total]])
    return counts


def patterns(demand: dict[int, int], capacity: int = CLASSES, rounds: int = 3_000) -> list[tuple[dict[int, int], int]]:
    """([class -> pieces of it], how often) that place every piece of `demand` (class -> pieces) exactly once.

    Column generation on the linear program starts from one pattern for each class and ends when no pattern improves it;
    `rounds` only bounds the driver's time, as every basis on the way is a valid answer.
    """
    size = np.array(sorted(c for c, n in demand.items() if n), np.int64)
    if not len(size):
        return []
    left = np.array([demand[int(c)] for c in size], np.int64)
    basis = np.diag(capacity // size).astype(float)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(size)))
        worth, column = _best_pattern(np.maximum(prices, 0), size, capacity)
        column[prices <= 0] = 0  # they were counted as worth nothing, but cost something
        if worth <= 1 + 1e-7:
            break
        amounts, direction = np.linalg.solve(basis, np.stack([left, column], axis=1).astype(float)).T
        ratio = np.full(len(size), np.inf)
        usable = direction > 1e-9
        ratio[usable] = np.maximum(amounts[usable], 0) / direction[usable]
        basis[:, int(ratio.argmin())] = column
    amounts = np.linalg.solve(basis, left.astype(float))
    out = []
    for column, often in zip(basis.T.round().astype(np.int64), np.floor(amounts + 1e-6).astype(np.int64), strict=True):
        used = column > 0
        often = int(min(often, (left[used] // column[used]).min()))
        if often > 0:
            left = left - often * column
            out.append(({int(c): int(k) for c, k in zip(size[used], column[used], strict=True)}, often))
    while left.any():  # what rounding left: at most one sequence's pieces for each pattern
        column = _fullest(left, size, capacity)
        used = column > 0
        often = int((left[used] // column[used]).min())
        left = left - often * column
        out.append(({int(c): int(k) for c, k in zip(size[used], column[used], strict=True)}, often))
    return out


def _slots(found: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By class: rows (first rank, first sequence, pieces a sequence) in order of rank."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    placed: dict[int, int] = {}
    sequence = 0
    for pattern, often in found:
        for c, k in pattern.items():
            slots.setdefault(c, []).append((placed.get(c, 0), sequence, k))
            placed[c] = placed.get(c, 0) + k * often
        sequence += often
    return {c: np.array(rows, np.int64) for c, rows in slots.items()}


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece with its sequence and offset; a sequence holds at most 4096 tokens.

    A null or empty text is the end id alone. Rows that share an id are documents of their own. An empty table gives no
    row; other columns are ignored. Only class counts and bucket counts (one per 100,000 pieces) reach the driver; a class
    that holds most pieces is ranked in many buckets.
    """
    rows = saved(pieces(docs, tokenizer).withColumn("class", F.ceil(F.col("length") / STEP).cast("int")))
    demand = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count("*").alias("n")).collect()}
    slots = _slots(patterns(demand))
    buckets = F.element_at(F.create_map(*[F.lit(x) for c in range(1, CLASSES + 1) for x in (c, 1 + demand.get(c, 0) // BUCKET_ROWS)]), F.col("class"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), buckets).cast("int"))
    before: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for r in sorted(rows.groupBy("class", "bucket").count().collect(), key=lambda r: (r["class"], r["bucket"])):
        before[r["class"], r["bucket"]] = total.get(r["class"], 0)
        total[r["class"]] = total.get(r["class"], 0) + r["count"]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            classes, bucket, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("class", "bucket", "rank"))
            sequence = np.zeros(len(classes), np.int64)
            keys, which = np.unique(np.stack([classes, bucket]), axis=1, return_inverse=True)
            for number, (c, b) in enumerate(keys.T.tolist()):
                own = which.reshape(-1) == number
                places = rank[own].astype(np.int64) + before[c, b]
                table = slots[c]
                row = table[np.searchsorted(table[:, 0], places, "right") - 1]
                sequence[own] = row[:, 1] + (places - row[:, 0]) // row[:, 2]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in _PIECES]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence)], [*_PIECES.names, "sequence_id"])

    placed = ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    ends = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("offset", ends - F.col("length"))
