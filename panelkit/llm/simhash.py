"""SimHash near-duplicates: links found through a table of Hamming distances to reference fingerprints.

Reference 0 has no bit set; reference j (1 to 32) has the two bits of block j. The distances of a fingerprint x to them,
d0 and dj, fix how many bits it has in each block: (d0 + 2 - dj) / 2. One differing bit changes one block's count by one,
so a pair with at most two differing bits has equal counts in at least two of the four groups of eight blocks. Rows that
agree on the table's entries of two groups meet (six keys a fingerprint); a pair is discarded when any coordinate of the
table differs by more than two, and what is left is verified on the fingerprints.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text, saved
from panelkit.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
GROUPS = 4  # MAX_BITS differing bits leave GROUPS - MAX_BITS groups untouched
#: Keys with more fingerprints than this meet again on further coordinates.
LARGE_KEY = 2_000
REFERENCES = np.array([0, *(3 << 2 * j for j in range(32))], np.uint64)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_POWERS = np.uint64(3) ** np.arange(32, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; 0 without words. Signed 64 bits."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ends = (starts[shingle:] - 1).tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)), np.uint64, len(ends))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([fingerprint(t) for t in texts], pa.int64())], ["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances (rows, references) of fingerprints to the references."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def _keys(table: np.ndarray, coordinates: list[int]) -> np.ndarray:
    """One number for the table's entries at some references (at most 32), relative to reference 0."""
    counts = (table[:, :1] + 2 - table[:, coordinates]) // 2
    return (counts.astype(np.uint64) * _POWERS[: len(coordinates)]).sum(axis=1, dtype=np.uint64).view(np.int64)


#: References by group, the pairs of groups that make a key, and for each the thirds of the references it leaves over.
_GROUP = [list(range(1 + 8 * g, 9 + 8 * g)) for g in range(GROUPS)]
_BANDS = [_GROUP[a] + _GROUP[b] for a, b in itertools.combinations(range(GROUPS), GROUPS - MAX_BITS)]
_THIRDS = [[part.tolist() for part in np.array_split(sorted(set(range(1, 33)) - set(band)), MAX_BITS + 1)] for band in _BANDS]


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, reps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        table = distance_table(fps)
        for number, band in enumerate(_BANDS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(fps), number * 4, np.int32)), pa.array(_keys(table, band)), pa.array(np.zeros(len(fps), np.int64)), pa.array(fps), pa.array(reps)],
                ["band", "key", "sub", "fp", "rep"],
            )


def _emit_subkeys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of large keys: two differing bits leave one third of the remaining references untouched."""
    for batch in batches:
        bands, keys, fps, reps = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("band", "key", "fp", "rep"))
        table = distance_table(fps)
        for number in np.unique(bands):
            own = bands == number
            for third, coordinates in enumerate(_THIRDS[number // 4], 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(own.sum(), number + third, np.int32)), pa.array(keys[own]), pa.array(_keys(table[own], coordinates)), pa.array(fps[own]), pa.array(reps[own])],
                    ["band", "key", "sub", "fp", "rep"],
                )


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node its edges reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link(group: np.ndarray, fps: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (rep, smaller rep) of the links inside equal, adjacent group numbers. Memory is linear in the rows."""
    n = len(fps)
    table = distance_table(fps).astype(np.int16)
    order = np.argsort(reps, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)  # nodes are numbered by rep, so that the smallest node is the smallest rep
    u = v = np.zeros(0, np.int64)
    left = np.arange(n)
    for shift in range(1, n):
        left = left[left < n - shift]
        left = left[group[left] == group[left + shift]]
        if not len(left):
            break
        near = left[np.abs(table[left, 0] - table[left + shift, 0]) <= MAX_BITS]
        near = near[(np.abs(table[near] - table[near + shift]) <= MAX_BITS).all(axis=1)]
        near = near[np.bitwise_count((fps[near] ^ fps[near + shift]).view(np.uint64)) <= MAX_BITS]
        u, v = np.concatenate([u, place[near]]), np.concatenate([v, place[near + shift]])
        if len(u) > 4 * n + 1000:
            label = _roots(n, u, v)
            u = np.flatnonzero(label != np.arange(n))
            v = label[u]
    label = _roots(n, u, v)
    u = np.flatnonzero(label != np.arange(n))
    return reps[order[u]], reps[order[label[u]]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; the last key of a batch waits for the next batch."""
    kept: pa.Table | None = None

    def edges(table: pa.Table) -> pa.RecordBatch:
        band, key, sub, fps, reps = (table.column(n).to_numpy() for n in ("band", "key", "sub", "fp", "rep"))
        change = (np.diff(band) != 0) | (np.diff(key) != 0) | (np.diff(sub) != 0)
        u, v = _link(np.concatenate([[0], np.cumsum(change)]), fps, reps)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        band, key, sub = (table.column(n).to_numpy() for n in ("band", "key", "sub"))
        same = (band == band[-1]) & (key == key[-1]) & (sub == sub[-1]) if len(band) else np.zeros(0, bool)
        first = int(np.argmax(same)) if same.any() else 0
        if first:
            yield edges(table.slice(0, first))
        kept = table.slice(first)
    if kept is not None and kept.num_rows:
        yield edges(kept)


def links(reps: DataFrame) -> DataFrame:
    """(u, v): edges between `rep` values whose components are those of all links between fingerprints of `reps` (fp, rep)."""
    rows = saved(reps.mapInArrow(_emit_keys, "band int, key long, sub long, fp long, rep long"))
    large = rows.groupBy("band", "key").count().where(F.col("count") > LARGE_KEY).select("band", "key")
    again = rows.join(large, ["band", "key"], "left_semi").mapInArrow(_emit_subkeys, rows.schema)
    meeting = rows.join(large, ["band", "key"], "left_anti").unionByName(again)
    return meeting.repartition("band", "key", "sub").sortWithinPartitions("band", "key", "sub").mapInArrow(_links, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id its links reach, itself included.

    Texts without words have fingerprint 0 and are linked like any other. Rows that share an id are one node. A row
    without an id takes the component of its fingerprint, or null where no row with that fingerprint has an id. Equal
    rows stay equal rows; an empty table gives none; other columns are ignored. Equal fingerprints are one row before the
    join, so copies never meet each other.
    """
    fps = saved(fingerprints(docs))
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = components(links(reps.where("rep IS NOT NULL"))).withColumnsRenamed({"node": "rep", "component": "component_id"})
    by_fp = reps.join(found, "rep", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    return fps.join(by_fp, "fp", "left").select("doc_id", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """near_duplicates() with the fingerprint as 16 hexadecimal digits."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
