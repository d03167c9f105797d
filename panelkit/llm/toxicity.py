"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

A token that mixes letters with look-alike signs, stretches letters, or is spelt out with gaps is a lattice of the letter
strings it may stand for; Viterbi decoding under a character model of the whole corpus picks one. Features of a text are
its words and their first letters. A feature's weight comes from how often it stands in toxic training texts, counted once
per left neighbour so that passages copied into many texts count once, and a logistic curve over a text's two strongest
weights gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text

TRAIN_DOCS = 12_000  # labelled texts that the classifier is fitted on: those with the smallest id hashes
STEM = 5  # letters of the feature that inflected forms share
MIN_SUPPORT = 4  # distinct left neighbours in toxic texts
THRESHOLD = 0.7

#: Signs that stand for letters.
LOOKALIKES = {
    b"0": b"o", b"1": b"il", b"3": b"e", b"4": b"a", b"5": b"s", b"6": b"g", b"7": b"t", b"8": b"b", b"9": b"g",
    b"@": b"a", b"$": b"s", b"!": b"i", b"|": b"il", b"+": b"t", b"(": b"c", b"<": b"c",
}
_SWAP_COST, _DROP_COST, _RUN_COST = 0.7, 0.5, 0.5  # negative log probabilities in the channel
_BREAK_COST = 0.5  # of a word's end inside a run
_ORDER = 4  # characters of the model's n-grams: a table of 32^4 counts whatever the corpus
#: Character classes: 0 for the edge of a word, 1-26 for letters, 27 for bytes of other letters.
_CLASS = np.array([b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else 27 if b >= 0x80 else 0 for b in range(256)], np.int64)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_EDGES = b".,;:?\"'[]{}%*#&=_~-\\/)>!|$("
_STRETCHED = re.compile(rb"([a-z])\1\1")
_SPELT = re.compile(rb"(?:[a-z0-9@$!|+]|[\xc0-\xff][\x80-\xbf]+)(?:[.\-_*~/,](?:[a-z0-9@$!|+]|[\xc0-\xff][\x80-\xbf]+)){2,}")
_GAPS = re.compile(rb"[.\-_*~/,]")
_MIXED = re.compile(rb"[0-9@$!|+(<]*[a-z\x80-\xff][a-z0-9@$!|+(<\x80-\xff]*")
_ONE_SIGN = re.compile(rb"[\xc0-\xff][\x80-\xbf]{1,3}")
_SAME = {b: re.compile(bytes([b]) + b"+") for b in range(97, 123)}
_SIGNS = re.compile(rb"[0-9@$!|+(<]")
_SINGLES = re.compile(rb"\x01{3,}")


def character_counts(docs: DataFrame) -> DataFrame:
    """(gram int, n long): counts of all character 4-grams of every text; at most 32^4 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(32**_ORDER, np.int64)
        for _, texts in blocks(batches):
            codes = _CLASS[np.frombuffer(b" " + b" ".join(texts) + b"   ", np.uint8)]
            gram = (codes[:-3] << 15) | (codes[1:-2] << 10) | (codes[2:-1] << 5) | codes[3:]
            total += np.bincount(gram, minlength=len(total))
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 100_000):
            part = seen[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["gram", "n"])

    return id_and_text(docs).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(counts: DataFrame) -> np.ndarray:
    """Costs (negative log probabilities) of a character after three others, smoothed with the shorter contexts."""
    table = np.zeros(32**_ORDER)
    for row in counts.toLocalIterator():
        table[row["gram"]] = row["n"]
    table = table.reshape(32, 32, 32, 32)
    chance = np.full(32, 1 / 28)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        part = table.sum(axis=axes) if axes else table
        chance = (part + 4 * chance) / (part.sum(axis=-1, keepdims=True) + 4)
    return -np.log(chance).astype(np.float32)


class Decoder:
    """Viterbi decoding of character lattices under a character model, of any length and over all states.

    A state is the last three characters; a reading is a chain of pieces, so readings share what they have in common and those
    that are given up take no memory. A state is left out where another one of its place is ahead by more than it can ever
    lose: contexts differ for three characters at most, and the most that each of them can make up is known from the model.
    That never changes the reading found.
    """

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        used = np.asarray(table, np.float64)[:28, :28, :28, :28]
        third = (used - used.min(axis=(0, 1, 2))).max(axis=3)
        second = (used - used.min(axis=(0, 1))).max(axis=(2, 3))
        first = (used - used.min(axis=0)).max(axis=(1, 2, 3))
        slack = np.zeros((32, 32, 32))
        slack[:28, :28, :28] = third + second[None] + first[None, None] + 1e-3  # sums are rounded
        self.costs = memoryview(np.ascontiguousarray(table, np.float32).ravel())
        self.slack = memoryview(slack.ravel())

    def __reduce__(self):
        return Decoder, (self.table,)

    def read(self, token: bytes, breaks: bool = False) -> bytes:
        """The most likely word behind a disguised token (lower case). With `breaks` a word may end at every place, and the
        words are returned with spaces between them. Of equally likely readings the one that is met first holds."""
        costs, slack, last = self.costs, self.slack, len(token)
        waiting: dict[int, dict[int, tuple]] = {0: {0: (0.0, None)}}
        for at in range(last):
            here = waiting.pop(at)
            edges = [(waiting.setdefault(end, {}), end < last, letters, _CLASS[list(letters)].tolist(), price) for end, letters, price in _edges(token, at)]
            limit = min(cost + slack[state] for state, (cost, _) in here.items()) if len(here) > 4 else math.inf
            for state, (cost, chain) in here.items():
                if cost > limit:
                    continue
                for then, inside, letters, codes, price in edges:
                    to, total = state, cost + price
                    for code in codes:
                        total += costs[to << 5 | code]
                        to = (to & 1023) << 5 | code
                    old = then.get(to)
                    if old is None or total < old[0]:
                        then[to] = (total, (letters, chain) if letters else chain)
                    if breaks and inside and to & 31:
                        total += costs[to << 5] + _BREAK_COST
                        to = (to & 1023) << 5
                        old = then.get(to)
                        if old is None or total < old[0]:
                            then[to] = (total, (letters + b" ", chain))
        chain = min((cost + costs[state << 5], state, chain) for state, (cost, chain) in waiting[last].items())[2]
        pieces = []
        while chain:
            piece, chain = chain
            pieces.append(piece)
        return b"".join(reversed(pieces))


def _edges(token: bytes, at: int) -> list[tuple[int, bytes, float]]:
    """(next place, letters, cost) of what the sign at a place may stand for."""
    sign = token[at : at + 1]
    if token[at] >= 0x80:
        return [(at + 1, sign, 0.0)]
    if not 97 <= token[at] <= 122:
        swapped = [(at + 1, bytes([letter]), _SWAP_COST) for letter in LOOKALIKES.get(sign, b"")]
        return [*swapped, (at + 1, b"", _DROP_COST + (6.0 if sign in LOOKALIKES else 0.0))]
    edges = [(at + 1, sign, 0.0)]
    if token[at + 1 : at + 2] == sign and (at == 0 or token[at - 1 : at] != sign):
        end = _SAME[token[at]].match(token, at).end()
        paid = _RUN_COST if end - at > 2 else 5 * _RUN_COST  # many words have a letter twice
        edges += [(end, sign, paid), (end, sign * 2, paid)]
    return edges


def restore(token: bytes, costs: np.ndarray | Decoder, breaks: bool = False) -> bytes:
    """Decoder.read() with the decoder of a character model."""
    return _decoder(costs).read(token, breaks)


def _decoder(costs: np.ndarray | Decoder) -> Decoder:
    return costs if isinstance(costs, Decoder) else Decoder(costs)


def _token_words(core: bytes, decoder: Decoder) -> Iterator[bytes]:
    """Words of a disguised token, of any length: the token as one word, and what is spelt out also with ends of words inside."""
    yield decoder.read(core)
    if _SPELT.fullmatch(core):
        yield from decoder.read(_GAPS.sub(b"", core), breaks=True).split()


def _disguised(token: bytes) -> list[bytes]:
    """What to decode of a token: nothing, its core, or also the core with the signs at its ends that may be letters."""
    if token.isalpha() and not _STRETCHED.search(token):
        return []
    core, tight = token.strip(_EDGES), token.strip(b".,;:?\"'")
    if not core or core.isalpha() and not _STRETCHED.search(core):
        # a word with signs around it; a sign at its end may still stand for a letter
        return [tight] if _MIXED.fullmatch(tight) and _SIGNS.search(tight) else []
    if _SPELT.fullmatch(core) or _STRETCHED.search(core) or _MIXED.fullmatch(core) and _SIGNS.search(core):
        return [core, tight] if tight != core and _MIXED.fullmatch(tight) else [core]
    return []


def restored(text: bytes, costs: np.ndarray | Decoder) -> Iterator[tuple[bytes, bytes]]:
    """(token before, word): words (letters only, lower case) that disguised tokens of a text stand for, once for each
    different token before them."""
    decoder = _decoder(costs)
    tokens = text.translate(_LOWER).split()
    words = {}
    for token in set(tokens):
        if parts := _disguised(token):
            words[token] = list(dict.fromkeys(w for part in parts for w in _token_words(part, decoder)))
    if words:
        for left, token in dict.fromkeys(pair for pair in zip([b"", *tokens], tokens, strict=False) if pair[1] in words):
            yield from ((left, word) for word in words[token])
    # letters spelt out with spaces: three or more tokens of one sign in a row
    for match in _SINGLES.finditer(bytes(1 if len(t) == 1 or t[0] >= 0xC0 and _ONE_SIGN.fullmatch(t) else 2 for t in tokens)):
        run, left = b"".join(tokens[match.start() : match.end()]), tokens[match.start() - 1] if match.start() else b""
        yield left, decoder.read(run)
        for word in decoder.read(run, breaks=True).split():
            yield left, word
            left = word


def restored_words(text: bytes, costs: np.ndarray | Decoder) -> list[bytes]:
    """The different words of restored()."""
    return list(dict.fromkeys(word for _, word in restored(text, costs)))


def _feature(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _features(words: set[bytes]) -> set[bytes]:
    """Whole words, and stems with a sign that no word has."""
    return {w for w in words if len(w) > 2} | {w[:STEM] + b"*" for w in words if len(w) >= STEM}


@dataclass
class Model:
    """Everything a text is scored with; its size does not grow with the corpus."""

    costs: np.ndarray
    weights: dict[int, float]
    curve: np.ndarray  # constant, and factors of the strongest and second strongest weight

    def __post_init__(self) -> None:
        self.decoder = Decoder(self.costs)

    def inputs(self, text: bytes) -> tuple[float, float]:
        words = {*text.translate(_PLAIN).split(), *restored_words(text, self.decoder)}
        get = self.weights.get
        by_word = []
        for word in words:
            weight = max(get(_feature(word), 0.0), get(_feature(word[:STEM] + b"*"), 0.0) if len(word) >= STEM else 0.0)
            if weight:
                by_word.append(weight)
        by_word = sorted(by_word, reverse=True)[:2] + [0.0, 0.0]
        return by_word[0], by_word[1]

    def score(self, first: float, second: float) -> float:
        return 1 / (1 + math.exp(-float(self.curve @ (1.0, first, second))))


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, features: int | None = None) -> Model:
    """Fits on rows of `labels` (doc_id, toxic); which rows those are is the caller's choice. `features`: how many features may
    have a weight, the surest first; None means all that pass.

    The character model counts every text of `docs`. Labels that are null, or whose id is null or not in `docs`, are left
    out; of several labels of an id the largest holds. Without any usable label every score is 0.5.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    costs = character_model(character_counts(docs))
    decoder = Decoder(costs)
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")  # at most TRAIN_DOCS rows

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(2).to_pylist()
            done = 0
            for _, part in blocks(iter([batch])):
                rows = set()
                for text, label in zip(part, toxic[done : done + len(part)], strict=True):
                    words = text.translate(_PLAIN).split()
                    left = b""
                    for word in words:
                        if len(word) > 2:
                            context = hash_of(left)
                            rows.add((_feature(word), context, label))
                            if len(word) >= STEM:
                                rows.add((_feature(word[:STEM] + b"*"), context, label))
                        left = word
                    for left, word in restored(text, decoder):
                        for feature in _features({word}):
                            rows.add((_feature(feature), hash_of(left), label))
                done += len(part)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["feature", "context", "toxic"])

    def hash_of(word: bytes) -> int:
        return xxhash.xxh32_intdigest(word) - (1 << 31)

    seen = texts.mapInArrow(emit, "feature long, context int, toxic int").distinct()
    counts = seen.groupBy("feature").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).where(F.col("bad") >= MIN_SUPPORT)
    # lower end of the interval (1.64 deviations) of the share of toxic texts
    share, z = F.col("bad") / F.col("n"), 1.64
    low = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    kept = counts.withColumn("low", low).where(F.col("low") > 0.5)
    if features is not None:
        kept = kept.orderBy(F.desc("low"), "feature").limit(features)
    model = Model(costs, {r["feature"]: float(r["low"]) for r in kept.collect()}, np.zeros(3))
    sample = np.array([(r["first"], r["second"], r["toxic"]) for r in _inputs(texts, model).collect()], float).reshape(-1, 3)
    if len(sample):
        model.curve = _fit_curve(np.column_stack([np.ones(len(sample)), sample[:, :2]]), sample[:, 2])
    return model


def _inputs(texts: DataFrame, model: Model) -> DataFrame:
    """The texts' columns other than the text, with the two strongest weights; one row per row."""
    rest = [c for c in texts.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.inputs(text) for _, part in blocks(iter([batch])) for text in part]
            columns = [batch.column(0), *(batch.column(batch.schema.get_field_index(c)) for c in rest)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([v[0] for v in values], pa.float64()), pa.array([v[1] for v in values], pa.float64())], ["doc_id", *rest, "first", "second"])

    kinds = dict(texts.dtypes)
    return texts.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in ["doc_id", *rest]) + ", first double, second double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row. Null and empty texts score as texts without any weighted word; equal rows
    give equal rows; an empty table gives none; other columns are ignored. A text is scored whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in blocks(batches):
            scores = [model.score(*model.inputs(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(ids: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 1 when divided by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(labels["doc_id"])).select(labels["doc_id"], labels["toxic"])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score() by a model trained on the labels that are not held out, with the held_out flag."""
    found = score(docs, train(docs, training_labels(labels)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns."""
    model = train(docs, training_labels(labels))

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.score(*model.inputs(t.encode())) < THRESHOLD)

    return docs.where(clean(F.coalesce(docs["text"].cast("string"), F.lit(""))))
