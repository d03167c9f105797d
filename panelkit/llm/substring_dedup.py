"""Removal of repeated runs of words: matching statistics of documents against compressed full-text indexes of shards.

A window is 20 consecutive words of a document. Documents cannot be searched in the indexes of all shards, as that grows with
the square of the corpus; so windows are dealt to shards by their own words. A trigger, the run of 8 words with the smallest
hash in a window, depends on the window's words only. Neighbouring windows with one trigger are a piece of 20 to 32 words that
goes to the trigger's shard, and equal windows meet there wherever they stand. Only triggers that stand in two documents send
pieces at all. A trigger with very many pieces (a phrase that a third of all documents hold) would make a large shard; its
windows go one by one to the shards of their own hashes.

A shard indexes its distinct pieces (Burrows-Wheeler transform in a wavelet tree) and streams them through backward search.
Where a match has the length of a window, the interval tells the smallest document that holds it: words decide, not hashes.
Repeats inside one document need no shard.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm import exchange
from panelkit.llm.exchange import NO_ID, Chunk, expand, expand_numbers, squeeze, squeeze_numbers
from panelkit.llm.fm_index import FmIndex, matching_statistics
from panelkit.llm.hashing import _BASE, _INVERSE, _VALUES, _powers_of, mix
from panelkit.llm.suffix_dedup import _least, _ranges, _six, _sliding

LENGTH = 20  # words of a window
TRIGGER = 8  # words of a trigger
_NEAR = LENGTH - TRIGGER + 1  # triggers that a window can depend on
HOT_PIECES = 1000  # pieces of a trigger from which its windows go one by one; decides where words meet, not what is equal
SHARD_BYTES = 8 << 20  # text whose windows meet in one shard
_BLOCK = 1 << 22  # bytes that are hashed at once
_BASE_2, _INVERSE_2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_KEYS, _PIECES = 0, 1  # kinds of questions
_SPACES = re.compile(rb"[\t-\r][\t-\r ]*| [\t-\r ]+")  # what is not a single space already


@dataclass
class Words:
    """The words of a chunk, each with one space behind it: word w is text[starts[w] : starts[w + 1] - 1]."""

    text: bytes
    starts: np.ndarray
    edges: np.ndarray  # words before each document, and of all
    hashes: np.ndarray

    @classmethod
    def of(cls, chunk: Chunk) -> Words:
        parts, edges = [], [0]
        for low, high in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True):
            own = _SPACES.sub(b" ", chunk.data[low:high]).strip(b" ")
            edges.append(edges[-1] + (own.count(b" ") + 1 if own else 0))
            if own:
                parts += [own, b" "]
        text = b"".join(parts)
        data = np.frombuffer(text, np.uint8)
        starts = np.concatenate([[0], np.flatnonzero(data == 32) + 1])
        return cls(text, starts, np.array(edges, np.int64), _word_hashes(data, starts))

    def doc_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, word, "right") - 1


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word that does not depend on where it stands; scratch memory is that of a block (or of one long word)."""
    parts, low = [np.zeros(0, np.uint64)], 0
    while low < len(starts) - 1:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + _BLOCK, "right")) - 1)
        part = data[starts[low] : starts[high]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * _powers_of(_BASE, len(part)), out=sums[1:])
        own = starts[low : high + 1] - starts[low]
        parts.append(mix((sums[own[1:] - 1] - sums[own[:-1]]) * _powers_of(_INVERSE, len(part) + 1)[own[:-1]]))
        low = high
    return np.concatenate(parts)


def _prefixes(words: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers_of(base, len(words)), out=out[1:])
    return out


@dataclass
class Pieces:
    """Stretches of windows that depend on one trigger: first window (by its first word), how many, the hash that deals them
    to a shard, and that of all their words."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    whole: np.ndarray

    def chosen(self, which: np.ndarray) -> Pieces:
        return Pieces(self.start[which], self.count[which], self.key[which], self.whole[which])


def parse(words: Words) -> Pieces:
    """The pieces of all windows of a chunk, in order."""
    n = len(words.hashes) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = _prefixes(words.hashes, _BASE)
    back = _powers_of(_INVERSE, len(sums))
    triggers = len(words.hashes) - TRIGGER + 1
    rolling = mix((sums[TRIGGER:] - sums[:triggers]) * back[:triggers])
    # the upper half of a hash decides, then the earlier place
    order = (rolling & np.uint64(0xFFFFFFFF00000000)) | np.arange(triggers, dtype=np.uint64)
    first = _sliding(order, _NEAR, np.minimum) & np.uint64(0xFFFFFFFF)
    document = np.repeat(np.arange(len(words.edges) - 1), np.diff(words.edges))[:n]
    inside = np.arange(n) + LENGTH <= words.edges[document + 1]
    change = np.ones(n, bool)
    change[1:] = (first[1:] != first[:-1]) | (document[1:] != document[:-1]) | (inside[1:] != inside[:-1])
    at = np.flatnonzero(change)
    count = np.diff(np.append(at, n))
    at, count = at[inside[at]], count[inside[at]]
    trigger = first[at].astype(np.int64)
    whole = mix((sums[at + count + LENGTH - 1] - sums[at]) * back[at] + (trigger - at).astype(np.uint64))
    return Pieces(at, count, mix(rolling[trigger]), whole)  # a trigger's own hash is among the smallest


def windows(pieces: Pieces, words: Words) -> Pieces:
    """Every window as a piece of its own, dealt by its own hash."""
    start = _ranges(pieces.start, pieces.count)
    if not len(start):
        return pieces.chosen(np.zeros(0, np.int64))
    one = _prefixes(words.hashes, _BASE)
    two = _prefixes(words.hashes, _BASE_2)
    first = mix((one[start + LENGTH] - one[start]) * _powers_of(_INVERSE, len(one))[start])
    second = mix((two[start + LENGTH] - two[start]) * _powers_of(_INVERSE_2, len(two))[start])
    return Pieces(start, np.ones(len(start), np.int64), first, second)


def repeated_inside(words: Words, found: Pieces) -> np.ndarray:
    """Starts of windows that also start earlier in their own document, by 128 bits of their hash."""
    document = words.doc_of(found.start)
    order = np.lexsort((found.key, document))
    equal = (found.key[order][1:] == found.key[order][:-1]) & (document[order][1:] == document[order][:-1])
    several = np.zeros(len(order), bool)
    several[order] = np.append(False, equal) | np.append(equal, False)
    own = windows(found.chosen(several), words)
    document = words.doc_of(own.start)
    order = np.lexsort((own.start, own.whole, own.key, document))
    equal = np.ones(max(0, len(order) - 1), bool)
    for column in (document, own.key, own.whole):
        equal &= column[order][1:] == column[order][:-1]
    return own.start[order[1:][equal]]


def _ask_keys(chunk: Chunk, buckets: int) -> list[tuple]:
    """Of each trigger: is it in several documents of the chunk, and with how many different pieces."""
    words = Words.of(chunk)
    found = parse(words)
    if not len(found.key):
        return []
    order = np.lexsort((found.whole, found.key))
    key, whole, ids = found.key[order], found.whole[order], chunk.ids[words.doc_of(found.start)][order]
    new = np.append(True, key[1:] != key[:-1])
    start = np.flatnonzero(new)
    different = np.add.reduceat((new | np.append(True, whole[1:] != whole[:-1])).astype(np.int64), start)
    many = np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)
    told = (np.minimum(different, 0x7FFF) << 1 | many).astype("<u2")
    return [(chunk.name, bucket, _KEYS, _six(key[start][part]), squeeze(told[part].tobytes()), None) for bucket, part in exchange.by_bucket(key[start], buckets)]


def _judge_keys(rows: list[dict]) -> list[tuple]:
    """For each trigger: 0 in one document only, 1 in several, 2 in several and with very many pieces."""
    sizes = [len(row["a"]) // 6 for row in rows]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(row["a"] for row in rows), np.uint8).reshape(-1, 6)
    told = np.frombuffer(b"".join(expand(row["b"]) for row in rows), "<u2").astype(np.int64)
    _, group, chunks = np.unique(raw.view("<u8").reshape(-1), return_inverse=True, return_counts=True)
    pieces, several = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), bool)
    np.add.at(pieces, group, told >> 1)
    np.logical_or.at(several, group, (told & 1).astype(bool))
    verdict = np.where(several | (chunks > 1), np.where(pieces > HOT_PIECES, 2, 1), 0).astype(np.uint8)[group]
    return [(row["chunk"], row["bucket"], _KEYS, squeeze(part.tobytes()), None, None) for row, part in zip(rows, np.split(verdict, np.cumsum(sizes)[:-1]), strict=True)]


@dataclass
class Asked:
    """What a chunk asks about its repeated triggers; built the same way in every pass."""

    words: Words
    found: Pieces  # all of the chunk
    pieces: Pieces  # those that are asked about
    entry: np.ndarray  # the distinct piece of each
    entries: np.ndarray  # one piece of each distinct one, in order of shard
    entry_id: np.ndarray  # the smallest id of each

    @classmethod
    def of(cls, chunk: Chunk, answers: list[dict]) -> Asked:
        words = Words.of(chunk)
        found = parse(words)
        keys, group = np.unique(found.key, return_inverse=True)
        told = b"".join(expand(row["a"]) for row in answers)
        if len(told) != len(keys):
            raise RuntimeError("answers do not fit the chunk")
        verdict = np.frombuffer(told, np.uint8)[group] if len(keys) else np.zeros(0, np.uint8)
        some, hot = found.chosen(verdict == 1), windows(found.chosen(verdict == 2), words)
        own = Pieces(*(np.concatenate([getattr(some, f), getattr(hot, f)]) for f in ("start", "count", "key", "whole")))
        # sorted by what deals them to shards; pieces of one trigger with equal hashes of all their words are one
        order = np.lexsort((own.whole, own.key))
        new = np.ones(len(order), bool)
        new[1:] = (own.key[order][1:] != own.key[order][:-1]) | (own.whole[order][1:] != own.whole[order][:-1])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        entries = order[new]
        return cls(words, found, own, entry, entries, _least(entry, len(entries), chunk.ids[words.doc_of(own.start)]))


def _ask_pieces(chunk: Chunk, kinds: dict[int, list[dict]], buckets: int) -> pa.Table:
    asked = Asked.of(chunk, kinds.get(_KEYS, []))
    data, rows = np.frombuffer(asked.words.text, np.uint8), []
    for bucket, part in exchange.by_bucket(asked.pieces.key[asked.entries], buckets):
        own = asked.pieces.chosen(asked.entries[part])
        low, high = asked.words.starts[own.start], asked.words.starts[own.start + own.count + LENGTH - 1]
        text = data[_ranges(low, high - low)].tobytes()
        rows.append((chunk.name, bucket, _PIECES, squeeze_numbers(asked.entry_id[part]), squeeze(own.count.astype(np.uint8).tobytes()), squeeze(text)))
    return exchange.table(rows)


def _column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _judge_pieces(rows: list[dict]) -> list[tuple]:
    """For each piece a bit mask of its windows: set where the window stands in a document with a smaller id."""
    parts = [np.frombuffer(expand(row["b"]), np.uint8).astype(np.int64) for row in rows]
    sizes, counts = [len(p) for p in parts], np.concatenate(parts)
    ids = np.concatenate([expand_numbers(row["a"]) for row in rows])
    data = np.frombuffer(b"".join(expand(row["c"]) for row in rows), np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(data == 32) + 1])
    lengths = counts + LENGTH - 1
    edges = np.concatenate([[0], np.cumsum(lengths)])
    distinct = _column(data, starts[edges]).dictionary_encode()  # equal by their bytes
    entry = distinct.indices.to_numpy().astype(np.int64)
    first = np.unique(entry, return_index=True)[1]
    entry_id = _least(entry, len(first), ids)
    words = _column(data, starts).dictionary_encode().indices.to_numpy()[_ranges(edges[first], lengths[first])]
    del data, starts, distinct  # the index has no need of the text
    index = FmIndex(words, lengths[first], entry_id, LENGTH)
    length, least = matching_statistics(index, words, lengths[first])
    begin = np.cumsum(lengths[first]) - lengths[first]
    place = _ranges(np.zeros(len(first), np.int64), counts[first])
    at, owner = _ranges(begin, counts[first]), np.repeat(np.arange(len(first)), counts[first])
    later = (length[at] == LENGTH) & (least[at] < entry_id[owner])
    mask = np.zeros(len(first), np.uint32)
    np.bitwise_or.at(mask, owner[later], np.uint32(1) << place[later].astype(np.uint32))
    masks = np.where(ids > entry_id[entry], np.uint32(0xFFFFFFFF), mask[entry]).astype("<u4")
    return [(row["chunk"], row["bucket"], _PIECES, squeeze(part.tobytes()), None, None) for row, part in zip(rows, np.split(masks, np.cumsum(sizes)[:-1]), strict=True)]


def spans_of(chunk: Chunk, kinds: dict[int, list[dict]]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The chunk's words, and starts and ends (in words) of the maximal runs that repeat."""
    asked = Asked.of(chunk, kinds.get(_KEYS, []))
    masks = np.frombuffer(b"".join(expand(row["a"]) for row in kinds.get(_PIECES, [])), "<u4")
    if len(masks) != len(asked.entries):
        raise RuntimeError("answers do not fit the chunk")
    words, own = asked.words, asked.pieces
    ids = chunk.ids[words.doc_of(own.start)]
    mask = np.where(ids > asked.entry_id[asked.entry], np.uint32(0xFFFFFFFF), masks[asked.entry]) if len(own.start) else np.zeros(0, np.uint32)
    place = _ranges(np.zeros(len(own.start), np.int64), own.count)
    starts = _ranges(own.start, own.count)[(np.repeat(mask, own.count) >> place.astype(np.uint32)) & 1 > 0]
    starts = np.unique(np.concatenate([starts, repeated_inside(words, asked.found)]))
    if not len(starts):
        return words, starts, starts
    document = words.doc_of(starts)
    new = np.append(True, (starts[1:] > starts[:-1] + LENGTH) | (document[1:] != document[:-1]))
    first = np.flatnonzero(new)
    return words, starts[first], starts[np.append(first[1:], len(starts)) - 1] + LENGTH


def _kept(chunk: Chunk, kinds: dict[int, list[dict]]) -> Iterator[tuple]:
    words, starts, ends = spans_of(chunk, kinds)
    cuts = np.searchsorted(starts, words.edges)
    for number, doc_id in enumerate(chunk.ids.tolist()):
        low, high = int(words.edges[number]), int(words.edges[number + 1])
        own = slice(cuts[number], cuts[number + 1])
        pieces, at, removed = [], low, 0
        for start, end in zip(starts[own].tolist(), ends[own].tolist(), strict=True):
            pieces.append(words.text[words.starts[at] : words.starts[start]])
            at, removed = end, removed + end - start
        pieces.append(words.text[words.starts[at] : words.starts[high]])
        yield None if doc_id == NO_ID else doc_id, high - low, removed, len(pieces) - 1, b"".join(pieces)[:-1]


def _answers(docs: DataFrame) -> DataFrame:
    buckets = exchange.bucket_count(docs, SHARD_BYTES)
    keys = exchange.answer(exchange.ask(docs, lambda chunk: _ask_keys(chunk, buckets)), _judge_keys)
    pieces = exchange.meet(docs, keys, lambda chunk, kinds: _ask_pieces(chunk, kinds, buckets), exchange.SCHEMA)
    return keys.unionByName(exchange.answer(pieces, _judge_pieces))


_OUT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]


def _result(docs: DataFrame, last: str, kind: pa.DataType, made) -> DataFrame:
    columns = [*_OUT, (last, kind)]

    def use(chunk: Chunk, kinds: dict[int, list[dict]]) -> pa.Table:
        rows = [(*row[:-1], made(row[-1])) for row in _kept(chunk, kinds)]
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), columns, strict=True)], names=[n for n, _ in columns])

    return exchange.meet(docs, _answers(docs), use, f"doc_id long, n_words long, n_removed long, n_spans long, {last} string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept): texts without the words that a window of 20 covers which also starts
    earlier, in a document with a smaller id or before in the same document; kept words are joined by one space.

    Words are what stands between spaces and the signs from tab to carriage return. A null text has none; texts of fewer
    than 20 words stay as they are. A row without an id counts as larger than every id, and like rows that repeat an id,
    such rows do not count as earlier than each other. An empty table gives no row; other columns are ignored. `docs` must
    come from a table, or be checkpointed, as it is read several times.
    """
    return _result(docs, "kept", pa.string(), lambda kept: kept.decode())


def digest(docs: DataFrame) -> DataFrame:
    """remove_repeats() with the kept words' SHA-256 in their place, taken where the words are."""
    return _result(docs, "kept_sha256", pa.string(), lambda kept: hashlib.sha256(kept).hexdigest())
