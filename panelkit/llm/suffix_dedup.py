"""Removal of repeated byte strings through prefix-free parsing.

A rolling hash over 24 bytes decides where phrases begin: a position triggers when its hash is the smallest of some 27
neighbours, so every string of 50 bytes holds a trigger, and the trigger it depends on (the first smallest) is decided by
its own bytes: equal strings are cut alike wherever they stand. The strings that depend on one trigger form a phrase
context of at most 76 bytes: the end of the phrase before it and what the parse puts behind it.

Only triggers whose 24 bytes stand in two documents can lead to a repeat; all others drop out after one small exchange.
The contexts of the rest form the dictionary: equal contexts are one entry with the smallest id. In each bucket a suffix
array of the dictionary, cut off at 50 bytes, puts equal strings next to each other, which gives the smallest id of each.
Triggers that stand in very many chunks (a line that a third of all documents hold) would make large buckets; their
strings are exchanged one by one instead, by their own hash, so equal ones still meet once per chunk and different ones
spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm import exchange
from panelkit.llm.exchange import NO_ID, Chunk, expand, expand_numbers, squeeze, squeeze_numbers
from panelkit.llm.hashing import _BASE, _INVERSE, _VALUES, _powers_of, mix

LENGTH = 50  # bytes of a string that must not repeat
TRIGGER = 24  # bytes under the rolling hash
_NEAR = LENGTH - TRIGGER + 1  # triggers that a string can depend on
HOT_CHUNKS = 32  # chunks with a trigger from which its strings are exchanged one by one
_BLOCK = 1 << 19  # positions that are scanned at once
_KEYS, _CONTEXTS, _STRINGS = 0, 1, 2  # kinds of questions


@dataclass
class Contexts:
    """Stretches of string starts that depend on one trigger: start, how many, the trigger's hash and the context's."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    whole: np.ndarray

    def chosen(self, which: np.ndarray) -> Contexts:
        return Contexts(self.start[which], self.count[which], self.key[which], self.whole[which])


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _powers_of(_BASE, len(data)), out=out[1:])
    return out


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """choose (minimum or maximum) over every `width` neighbours."""
    span = 1
    while 2 * span <= width:
        values = choose(values[:-span], values[span:])
        span *= 2
    return choose(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def parse(chunk: Chunk) -> Contexts:
    """The contexts of all strings of a chunk, in order. Long documents are scanned in blocks; memory is a block's."""
    parts = []
    data = np.frombuffer(chunk.data, np.uint8)
    last = len(data) - LENGTH  # the last start
    ends = chunk.offsets[1:]
    for low in range(0, last + 1, _BLOCK):
        high = min(low + _BLOCK, last + 1)
        part = data[low : high - 1 + LENGTH]
        sums = _sums(part)
        back = _powers_of(_INVERSE, len(sums))
        n = len(part) - TRIGGER + 1
        rolling = (sums[TRIGGER:] - sums[:n]) * back[:n]
        # order by the upper bits, the earlier position among equals
        order = ((rolling * np.uint64(0x9FB21C651E98DF25)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        first = _sliding(order, _NEAR, np.minimum) & np.uint64(0xFFFFFFFF)
        starts = np.arange(low, high)
        document = np.searchsorted(ends, starts, "right")
        inside = starts + LENGTH <= ends[np.minimum(document, len(ends) - 1)]
        change = np.ones(high - low, bool)
        change[1:] = (first[1:] != first[:-1]) | (document[1:] != document[:-1])
        change |= np.append(False, inside[1:] != inside[:-1])
        at = np.flatnonzero(change)
        count = np.diff(np.append(at, high - low))
        at, count = at[inside[at]], count[inside[at]]
        trigger = first[at].astype(np.int64)
        whole = (sums[at + count + LENGTH - 1] - sums[at]) * back[at]
        parts.append(Contexts(at + low, count, mix(rolling[trigger]), mix(whole + (trigger - at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))))
    if not parts:
        none = np.zeros(0, np.int64)
        return Contexts(none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Contexts(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "count", "key", "whole")])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), then the next."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _least(groups: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    out = np.full(n, NO_ID, np.int64)
    np.minimum.at(out, groups, values)
    return out


def _six(keys: np.ndarray) -> bytes:
    """The lower six bytes of each key; the bucket holds what more there is."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _ask_keys(chunk: Chunk, buckets: int) -> list[tuple]:
    found = parse(chunk)
    if not len(found.key):
        return []
    keys, group = np.unique(found.key, return_inverse=True)
    ids = chunk.ids[chunk.doc_of(found.start)]
    many = _least(group, len(keys), ids) != -_least(group, len(keys), -ids)
    return [(chunk.name, bucket, _KEYS, _six(keys[part]), many[part].astype(np.uint8).tobytes(), None) for bucket, part in exchange.by_bucket(keys, buckets)]


def _judge_keys(rows: list[dict]) -> list[tuple]:
    """For each key: 0 in one document only, 1 in several, 2 in several and very many chunks."""
    sizes = [len(row["b"]) for row in rows]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(row["a"] for row in rows), np.uint8).reshape(-1, 6)
    many = np.frombuffer(b"".join(row["b"] for row in rows), np.uint8)
    _, group, chunks = np.unique(raw.view("<u8").reshape(-1), return_inverse=True, return_counts=True)
    inside = np.zeros(len(chunks), np.uint8)
    np.maximum.at(inside, group, many)
    verdict = np.where(chunks > HOT_CHUNKS, 2, ((chunks > 1) | (inside > 0)).astype(np.uint8)).astype(np.uint8)[group]
    parts = np.split(verdict, np.cumsum(sizes)[:-1])
    return [(row["chunk"], row["bucket"], _KEYS, part.tobytes(), None, None) for row, part in zip(rows, parts, strict=True) if part.any()] + [
        # a bucket without any repeat answers with its length only
        (row["chunk"], row["bucket"], _KEYS, None, len(part).to_bytes(8, "little"), None) for row, part in zip(rows, parts, strict=True) if not part.any()
    ]


def _verdicts(found: Contexts, answers: list[dict]) -> np.ndarray:
    """The verdict on the key of each context."""
    if not len(found.key):
        return np.zeros(0, np.uint8)
    keys, group = np.unique(found.key, return_inverse=True)
    flags = b"".join(row["a"] if row["a"] is not None else bytes(int.from_bytes(row["b"], "little")) for row in answers)
    if len(flags) != len(keys):
        raise RuntimeError("answers do not fit the chunk")
    return np.frombuffer(flags, np.uint8)[group]


@dataclass
class Repeats:
    """What a chunk asks about the contexts whose trigger repeats; built the same way in every pass."""

    contexts: Contexts  # those of ordinary triggers
    entry: np.ndarray  # the dictionary entry of each
    entries: np.ndarray  # one context of each entry, in order of bucket
    entry_key: np.ndarray
    entry_id: np.ndarray  # the smallest id of each
    strings: np.ndarray  # starts of strings of hot triggers
    group: np.ndarray  # the distinct string of each
    hashes: np.ndarray  # ascending
    string_id: np.ndarray

    @classmethod
    def of(cls, chunk: Chunk, answers: list[dict]) -> Repeats:
        found = parse(chunk)
        verdict = _verdicts(found, answers)
        own, hot = found.chosen(verdict == 1), found.chosen(verdict == 2)
        # sorted by trigger first, as buckets are ranges of it
        order = np.lexsort((own.whole, own.key))
        new = np.ones(len(order), bool)
        new[1:] = (own.key[order][1:] != own.key[order][:-1]) | (own.whole[order][1:] != own.whole[order][:-1])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        entries = order[new]
        entry_id = _least(entry, len(entries), chunk.ids[chunk.doc_of(own.start)])
        strings = _ranges(hot.start, hot.count)
        if len(strings):
            lengths = hot.count + LENGTH - 1
            text = np.frombuffer(chunk.data, np.uint8)[_ranges(hot.start, lengths)]
            sums, at = _sums(text), _ranges(np.cumsum(lengths) - lengths, hot.count)
            hashes = mix((sums[at + LENGTH] - sums[at]) * _powers_of(_INVERSE, len(sums))[at])
        else:
            hashes = np.zeros(0, np.uint64)
        distinct, group = np.unique(hashes, return_inverse=True)
        return cls(own, entry, entries, own.key[entries], entry_id, strings, group, distinct, _least(group, len(distinct), chunk.ids[chunk.doc_of(strings)]))


def _ask_repeats(chunk: Chunk, kinds: dict[int, list[dict]], buckets: int) -> pa.Table:
    asked = Repeats.of(chunk, kinds.get(_KEYS, []))
    data = np.frombuffer(chunk.data, np.uint8)
    rows = []
    for bucket, part in exchange.by_bucket(asked.entry_key, buckets):
        own = asked.contexts.chosen(asked.entries[part])
        text = data[_ranges(own.start, own.count + LENGTH - 1)].tobytes()
        rows.append((chunk.name, bucket, _CONTEXTS, squeeze_numbers(asked.entry_id[part]), own.count.astype(np.uint8).tobytes(), squeeze(text)))
    for bucket, part in exchange.by_bucket(asked.hashes, buckets):
        rows.append((chunk.name, bucket, _STRINGS, squeeze_numbers(asked.string_id[part]), asked.hashes[part].tobytes(), None))
    return exchange.table(rows)


def suffix_array(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes at `starts` in the order of their first LENGTH bytes, and where these change."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    columns = [words[starts + at].copy().view(">u8").reshape(-1).astype(np.uint64) for at in (*range(0, LENGTH - 7, 8), LENGTH - 8)]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[order][1:] != column[order][:-1]
    return order, new


def _judge_contexts(rows: list[dict]) -> list[tuple]:
    """For each context a bit mask of its strings: set where the string stands in a document with a smaller id."""
    sizes = [len(row["b"]) for row in rows]
    ids = np.concatenate([expand_numbers(row["a"]) for row in rows])
    counts = np.frombuffer(b"".join(row["b"] for row in rows), np.uint8).astype(np.int64)
    text = np.frombuffer(b"".join(expand(row["c"]) for row in rows), np.uint8)
    lengths = counts + LENGTH - 1
    starts = np.cumsum(lengths) - lengths
    # the dictionary: equal contexts of all chunks are one entry
    sums = _sums(text)
    hashes = mix((sums[starts + lengths] - sums[starts]) * _powers_of(_INVERSE, len(sums))[starts] + lengths.astype(np.uint64))
    del sums
    _, first, entry = np.unique(hashes, return_index=True, return_inverse=True)
    entry_id = _least(entry, len(first), ids)
    mask = np.zeros(len(first), np.uint32)
    owner = np.repeat(np.arange(len(first)), counts[first])
    strings = _ranges(starts[first], counts[first])
    place = _ranges(np.zeros(len(first), np.int64), counts[first])
    # the trigger's bytes are inside every string, so slices by the strings' trigger would do; by their first word is as good
    least = np.empty(len(strings), np.int64)
    for part in _by_first_bytes(text, strings):
        order, new = suffix_array(text, strings[part])
        own = entry_id[owner[part]][order]
        group = np.cumsum(new) - 1
        lowest = np.minimum.reduceat(own, np.flatnonzero(new))
        result = np.empty(len(order), np.int64)
        result[order] = lowest[group]
        least[part] = result
    later = least < entry_id[owner]
    np.bitwise_or.at(mask, owner[later], np.uint32(1) << place[later].astype(np.uint32))
    masks = np.where(ids > entry_id[entry], np.uint32(0xFFFFFFFF), mask[entry]).astype(np.uint32)
    parts = np.split(masks, np.cumsum(sizes)[:-1])
    return [(row["chunk"], row["bucket"], _CONTEXTS, part.tobytes(), None, None) for row, part in zip(rows, parts, strict=True)]


def _by_first_bytes(text: np.ndarray, strings: np.ndarray, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Parts of the strings, each with all strings of some first two bytes, which bounds the suffix array's memory."""
    if len(strings) <= most:
        if len(strings):
            yield np.arange(len(strings))
        return
    lead = text[strings].astype(np.int64) << 8 | text[strings + 1]
    order = np.argsort(lead, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(lead[order], prepend=-1)), len(order))
    low = 0
    while low < len(edges) - 1:
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + most, "right")) - 1)
        yield order[edges[low] : edges[high]]
        low = high


def _judge_strings(rows: list[dict]) -> list[tuple]:
    """For each string of hot triggers: 1 where it stands in a document with a smaller id."""
    sizes = [len(row["b"]) // 8 for row in rows]
    hashes = np.frombuffer(b"".join(row["b"] for row in rows), np.uint64)
    ids = np.concatenate([expand_numbers(row["a"]) for row in rows])
    _, group = np.unique(hashes, return_inverse=True)
    later = (_least(group, int(group.max()) + 1, ids)[group] < ids).astype(np.uint8)
    parts = np.split(later, np.cumsum(sizes)[:-1])
    return [(row["chunk"], row["bucket"], _STRINGS, part.tobytes(), None, None) for row, part in zip(rows, parts, strict=True)]


def _judge(rows: list[dict]) -> list[tuple]:
    return (_judge_contexts if rows[0]["kind"] == _CONTEXTS else _judge_strings)(rows)


def spans_of(chunk: Chunk, kinds: dict[int, list[dict]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in the chunk, of the maximal runs of bytes that repeat."""
    asked = Repeats.of(chunk, kinds.get(_KEYS, []))
    masks = np.frombuffer(b"".join(row["a"] for row in kinds.get(_CONTEXTS, [])), np.uint32)
    later = np.frombuffer(b"".join(row["a"] for row in kinds.get(_STRINGS, [])), np.uint8)
    if len(masks) != len(asked.entries) or len(later) != len(asked.hashes):
        raise RuntimeError("answers do not fit the chunk")
    own = asked.contexts
    ids = chunk.ids[chunk.doc_of(own.start)]
    mask = np.where(ids > asked.entry_id[asked.entry], np.uint32(0xFFFFFFFF), masks[asked.entry]) if len(own.start) else np.zeros(0, np.uint32)
    place = _ranges(np.zeros(len(own.start), np.int64), own.count)
    starts = _ranges(own.start, own.count)[(np.repeat(mask, own.count) >> place.astype(np.uint32)) & 1 > 0]
    ids = chunk.ids[chunk.doc_of(asked.strings)]
    hot = (ids > asked.string_id[asked.group]) | (later[asked.group] > 0)
    starts = np.sort(np.concatenate([starts, asked.strings[hot]]))
    if not len(starts):
        return starts, starts
    document = chunk.doc_of(starts)
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > starts[:-1] + LENGTH) | (document[1:] != document[:-1])
    first = np.flatnonzero(new)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1] + LENGTH


_OUT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]


def _kept(chunk: Chunk, kinds: dict[int, list[dict]]) -> Iterator[tuple]:
    starts, ends = spans_of(chunk, kinds)
    edges = np.searchsorted(starts, chunk.offsets)
    for number, doc_id in enumerate(chunk.ids.tolist()):
        low, high = int(chunk.offsets[number]), int(chunk.offsets[number + 1])
        own = slice(edges[number], edges[number + 1])
        pieces, at = [], low
        for start, end in zip(starts[own].tolist(), ends[own].tolist(), strict=True):
            pieces.append(chunk.data[at:start])
            at = end
        pieces.append(chunk.data[at:high])
        kept = b"".join(pieces)
        yield None if doc_id == NO_ID else doc_id, high - low, high - low - len(kept), len(pieces) - 1, kept


def _answers(docs: DataFrame) -> DataFrame:
    buckets = exchange.bucket_count(docs)
    keys = exchange.answer(exchange.ask(docs, lambda chunk: _ask_keys(chunk, buckets)), _judge_keys)
    repeats = exchange.meet(docs, keys, lambda chunk, kinds: _ask_repeats(chunk, kinds, buckets), exchange.SCHEMA)
    return keys.unionByName(exchange.answer(repeats, _judge))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without the bytes that a string of 50 bytes covers which also
    starts in a document with a smaller id. `kept` is binary, as a span may end inside a character.

    A null text is empty; texts under 50 bytes stay. A row without an id counts as larger than every id, and like rows that
    repeat an id, such rows do not count as smaller than each other. An empty table gives no row; other columns are
    ignored. `docs` must come from a table, or be checkpointed, as it is read several times.
    """

    def use(chunk: Chunk, kinds: dict[int, list[dict]]) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*_kept(chunk, kinds), strict=True), _OUT, strict=True)], names=[n for n, _ in _OUT])

    return exchange.meet(docs, _answers(docs), use, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """remove_repeats() with the kept bytes' SHA-256 in their place, taken where the bytes are."""

    def use(chunk: Chunk, kinds: dict[int, list[dict]]) -> pa.Table:
        rows = [(*row[:4], hashlib.sha256(row[4]).hexdigest()) for row in _kept(chunk, kinds)]
        names = [*[n for n, _ in _OUT[:4]], "kept_sha256"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*[t for _, t in _OUT[:4]], pa.string()], strict=True)], names=names)

    return exchange.meet(docs, _answers(docs), use, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
