"""Cross-entropy difference: how much better a model of target texts predicts a document than one of the whole corpus.

Both models are word bigrams over one vocabulary, the words that the corpus holds at least twice; all others are one
unknown word. They are smoothed alike: a pair's count is backed by its second word's share, which a small count for every
word of the vocabulary keeps above zero. A document is scored by the counts of all other documents, its own are taken off.
Counts are gathered over every document: a chunk sends each distinct word and pair once, and gets both models' counts back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import exchange
from panelkit.llm.common import saved
from panelkit.llm.exchange import NO_ID, Chunk
from panelkit.llm.hashing import _BASE, mix, word_hashes

LEAST = 2  # times the corpus holds a word of the vocabulary
EXTRA = 0.5  # added to each word's count
BACKING = 4.0  # weight of the word's share behind a pair's count
CHUNK_BYTES = 8 << 20  # a pair is sent once per chunk, so larger chunks send less and hold more
_WORDS, _PAIRS, _SUMS, _TARGET = 0, 1, 2, 3
_SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, word key, pair key, whether the word has one before it) of each word."""
    edges = chunk.offsets.tolist()
    words, document = word_hashes([chunk.data[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    after = np.zeros(len(words), bool)
    after[1:] = document[1:] == document[:-1]
    pairs = np.zeros(len(words), np.uint64)
    pairs[1:] = mix(words[:-1] * _BASE + words[1:])
    return document, words, pairs, after


def _pack(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").tobytes())


def _unpack(rows: list[dict], column: str) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(expand(row[column]) for row in rows), "<u4").astype(np.int64)


def _marked(chunk: Chunk, kinds: dict[int, list[dict]]) -> np.ndarray:
    """Whether each document of the chunk is a target."""
    marked = np.zeros(len(chunk.ids), bool)
    marked[[row["bucket"] for row in kinds.get(_TARGET, [])]] = True
    return marked


def _ask(chunk: Chunk, target: np.ndarray, buckets: int) -> list[tuple]:
    document, words, pairs, after = _tokens(chunk)
    marked = target[document]
    rows = []
    for kind, keys, own in ((_WORDS, words, marked), (_PAIRS, pairs[after], marked[after])):
        distinct, group, total = np.unique(keys, return_inverse=True, return_counts=True)
        inside = np.bincount(group, weights=own, minlength=len(distinct)).astype(np.int64)
        for bucket, part in exchange.by_bucket(distinct, buckets):
            low = distinct[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            rows.append((chunk.name, bucket, kind, low, _pack(total[part]), _pack(inside[part])))
    return rows


def _reply(rows: list[dict]) -> list[tuple]:
    """Both models' counts of each key; of words also the bucket's sums."""
    sizes = [len(row["a"]) // 6 for row in rows]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(row["a"] for row in rows), np.uint8).reshape(-1, 6)
    distinct, group = np.unique(raw.view("<u8").reshape(-1), return_inverse=True)
    total, inside = (np.bincount(group, weights=_unpack(rows, c), minlength=len(distinct)).astype(np.int64) for c in ("b", "c"))
    edges = np.cumsum(sizes)[:-1]
    kind, bucket = rows[0]["kind"], rows[0]["bucket"]
    out = [
        (row["chunk"], bucket, kind, _pack(t), _pack(i), None)
        for row, t, i in zip(rows, np.split(total[group], edges), np.split(inside[group], edges), strict=True)
    ]
    if kind == _WORDS:
        rare = total < LEAST
        sums = [total.sum(), inside.sum(), (~rare).sum(), total[rare].sum(), inside[rare].sum()]
        out.append((0, bucket, _SUMS, np.array(sums, np.int64).tobytes(), None, None))
    return out


def _own(keys: np.ndarray, document: np.ndarray) -> np.ndarray:
    """How often the document of each key holds it."""
    _, group, count = np.unique(mix(keys + (document.astype(np.uint64) + np.uint64(1)) * _BASE), return_inverse=True, return_counts=True)
    return count[group]


def _losses(chunk: Chunk, kinds: dict[int, list[dict]], sums: np.ndarray) -> pa.Table:
    document, words, pairs, after = _tokens(chunk)
    n = len(chunk.ids)
    marked = _marked(chunk, kinds)
    tokens = np.bincount(document, minlength=n)
    losses = np.zeros((2, n))
    if len(words):
        _, group = np.unique(words, return_inverse=True)
        own_word = _own(words, document)
        _, pair_group = np.unique(pairs[after], return_inverse=True)
        own_pair = np.zeros(len(words), np.int64)
        own_pair[after] = _own(pairs[after], document[after])
        total = _unpack(kinds[_WORDS], "a")[group]
        known = total >= LEAST
        backed = after & known
        backed[1:] &= known[:-1]
        rare_own = np.bincount(document, weights=~known, minlength=n)
        all_total, all_inside, vocabulary, rare_total, rare_inside = sums.tolist()
        for model, (column, everything, rare, mine) in enumerate((("b", all_inside, rare_inside, marked), ("a", all_total, rare_total, np.ones(n, bool)))):
            here = mine[document]
            word = _unpack(kinds[_WORDS], column)[group] - own_word * here
            count = np.where(known, word, rare - (rare_own * mine)[document])
            share = (count + EXTRA) / ((everything - tokens * mine)[document] + EXTRA * (vocabulary + 1))
            pair = np.zeros(len(words), np.int64)
            if after.any():
                pair[after] = _unpack(kinds[_PAIRS], column)[pair_group]
            pair -= own_pair * here
            before = np.zeros(len(words), np.int64)
            before[1:] = word[:-1]
            chance = np.where(backed, (pair + BACKING * share) / (before + BACKING), share)
            losses[model] = np.bincount(document, weights=-np.log(chance), minlength=n) / np.maximum(tokens, 1)
    ids = [None if i == NO_ID else i for i in chunk.ids.tolist()]
    return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(tokens), pa.array(losses[0]), pa.array(losses[1]), pa.array(losses[0] - losses[1])], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row: losses in nats per word, score their
    difference; the lower the score, the more a text is like the target's.

    `target_ids` (doc_id) names the target documents; nulls, repeats and ids that are not in `docs` change nothing. Null
    and empty texts, and texts without words, have losses and score 0. Rows that repeat are documents of their own. An
    empty table gives no row; other columns are ignored. `docs` must come from a table or be checkpointed, as it is read
    several times.
    """
    named = target_ids.select(target_ids["doc_id"].cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    target = saved(exchange.marks(docs, named, _TARGET, CHUNK_BYTES))
    buckets = exchange.bucket_count(docs)
    questions = exchange.meet(docs, target, lambda chunk, kinds: exchange.table(_ask(chunk, _marked(chunk, kinds), buckets)), exchange.SCHEMA, CHUNK_BYTES)
    answers = saved(exchange.answer(questions, _reply))
    sums = sum((np.frombuffer(r["a"], np.int64) for r in answers.where(F.col("kind") == _SUMS).select("a").toLocalIterator()), np.zeros(5, np.int64))
    known = answers.where(F.col("kind") != _SUMS).unionByName(target)
    return exchange.meet(docs, known, lambda chunk, kinds: _losses(chunk, kinds, sums), _SCHEMA, CHUNK_BYTES)
