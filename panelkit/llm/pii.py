"""Personal data: patterns, and terms that the corpus shows to reveal who or what a pattern found.

Every value that a pattern finds is a protected entity. Terms near it are counted together with it, each distinct pair of
neighbours once, so that copies of a passage are one piece of evidence. A term t discloses an entity e when P(e | t), the
share of t's contexts in the whole corpus that lie near e, reaches a threshold and knowing t lowers the surprise at e by
enough bits, or by enough of that surprise where an entity is frequent. Such a term is generalised wherever it stands, or removed when it all but names the entity.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import blocks, id_and_text, saved

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 5  # words on either side of an entity that count as near
MIN_CONTEXTS = 3  # distinct contexts that a term and an entity must share
DISCLOSED = 0.5  # P(entity | term) from which a term is generalised
REMOVED = 0.9  # ... and from which it is removed
MIN_BITS = 8.0  # log2 P(entity | term) / P(entity), of an entity that has so many bits to gain
MIN_GAIN = 0.6  # ... and of any other as a share of -log2 P(entity), all that there is to gain
FILTER_BITS = 20  # size of the bitmap that keeps other words out of the shuffle; the join behind it is exact

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match cannot start inside a run of digits, so trying only its first digit keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from their @, so that long words without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            yield start, last
        at = text.find("@", match.end() if match else at + 1)


def _luhn(digits: str) -> bool:
    numbers = [ord(c) - 48 for c in reversed(digits)]
    return (sum(numbers[::2]) + sum(_DOUBLED[n] for n in numbers[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every pattern match that passes its test, in order; code points."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _context(text: str, word: re.Match) -> int:
    """A word's two neighbours, as far as they stand within 40 characters."""
    left = _WORD.findall(text, max(0, word.start() - 40), word.start())
    right = _WORD.search(text, word.end(), min(len(text), word.end() + 40))
    return _hash(f"{left[-1].lower() if left else ''} {right[0].lower() if right else ''}")


def _near(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(entity, term, context) hashes of the words around each span, as far as they stand within 40 characters a word."""
    reach = 40 * WINDOW
    for start, kind, end in spans:
        entity = _hash(f"{KINDS[kind]}:{text[start:end].lower()}")
        before, after = list(_WORD.finditer(text, max(0, start - reach), start))[-WINDOW:], list(_WORD.finditer(text, end, min(len(text), end + reach)))[:WINDOW]
        for word in before + after:
            yield entity, _hash(word[0].lower()), _context(text, word)


def near_terms(docs: DataFrame) -> DataFrame:
    """Distinct (entity, term, context) of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches):
            rows = {row for text in (t.decode("utf-8", "replace") for t in texts) for row in _near(text, base_spans(text))}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["entity", "term", "context"])

    return id_and_text(docs).mapInArrow(run, "entity long, term long, context long").distinct()


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Which hash values modulo 2^FILTER_BITS the terms have: at most 2^20 numbers reach the driver, however many terms."""
    places = terms.select(F.pmod("term", F.lit(1 << FILTER_BITS)).cast("int").alias("at")).distinct().toPandas()["at"].to_numpy()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[places.astype(np.int64)] = True
    return bits


def _passing(text: str, bits: np.ndarray, known: dict[str, int | None]) -> Iterator[tuple[re.Match, int]]:
    """Words whose hash is in the bitmap. `known` remembers words between texts."""
    mask = len(bits) - 1
    for match in _WORD.finditer(text):
        word = match[0].lower()
        try:
            value = known[word]
        except KeyError:
            value = _hash(word)
            value = known[word] = value if bits[value & mask] else None
        if value is not None:
            yield match, value


def _forget(known: dict) -> dict:
    return {} if len(known) > 500_000 else known


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """(term, share): hashes of terms that disclose some entity, with the largest P(entity | term)."""
    near = saved(near_terms(docs))
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= MIN_CONTEXTS)
    entities = near.groupBy("entity").agg(F.count("*").alias("entity_n"))
    pairs = saved(pairs.join(entities, "entity"))
    everything = near.count()
    bits = _bitmap(pairs)
    if not bits.any():
        return pairs.select("term", F.lit(0.0).alias("share")).limit(0)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int | None] = {}
        for _, texts in blocks(batches):
            rows: set[tuple[int, int]] = set()
            known = _forget(known)
            for text in (t.decode("utf-8", "replace") for t in texts):
                found = list(_passing(text, bits, known))
                rows.update((term, _context(text, match)) for match, term in found)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["term", "context"])

    seen = id_and_text(docs).mapInArrow(contexts, "term long, context long").distinct()
    totals = seen.join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("term_n"))
    shares = pairs.join(totals, "term").withColumn("share", F.col("both") / F.col("term_n"))
    unknown = -F.log2(F.col("entity_n") / F.lit(float(everything)))
    enough = F.log2("share") + unknown >= F.least(F.lit(MIN_BITS), MIN_GAIN * unknown) - 1e-9
    return shares.where((F.col("share") >= DISCLOSED) & enough).groupBy("term").agg(F.max("share").alias("share"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, terms) of every row: `base` and `terms` are arrays of (start, kind, end), `terms` with the share.

    Null and empty texts have no span; equal rows give equal rows; an empty table gives none; other columns are ignored.
    Texts are searched whole. Only a fixed-size bitmap of term hashes goes to all tasks; the terms themselves are joined.
    """
    terms = saved(disclosing_terms(docs))
    bits = _bitmap(terms)
    some = bool(bits.any())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int | None] = {}
        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
        word = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.int64())])
        for ids, texts in blocks(batches):
            known = _forget(known)
            base, words, keys = [], [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                found = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                keys.append(xxhash.xxh64_intdigest(raw) - (1 << 63))
                inside = []
                if some:
                    for m, term in _passing(text, bits, known):
                        if not any(a < m.end() and m.start() < b for a, _, b in found):
                            inside.append({"start": m.start(), "end": m.end(), "term": term})
                words.append(inside)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(base, pa.list_(span)), pa.array(words, pa.list_(word))], ["doc_id", "text_key", "base", "words"])

    rows = id_and_text(docs).mapInArrow(run, "doc_id long, text_key long, base array<struct<start:int,kind:int,end:int>>, words array<struct<start:int,end:int,term:long>>")
    if not some:
        return rows.select("doc_id", "text_key", "base", F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,share:double>>)").alias("terms"))
    rows = saved(rows)
    # by text, as equal texts have equal spans: a third of the rows may be copies of one
    hits = rows.where("size(words) > 0").dropDuplicates(["text_key"]).select("text_key", F.inline("words")).join(terms, "term")
    by_text = hits.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end", "share"))).alias("terms"))
    return rows.drop("words").join(by_text, "text_key", "left").select("doc_id", "text_key", "base", F.coalesce("terms", F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,share:double>>)")).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the base spans' digest, and all spans as text."""
    named = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", named[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(k):
        return lambda s: s["kind"] == k

    plain = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id",
        *[F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", plain))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with spans of personal data in `text` replaced by their kind and telling terms generalised or removed."""
    found = find(docs).select("text_key", F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(0.0).alias("share"))), "terms").alias("__spans")).dropDuplicates(["text_key"])

    @F.pandas_udf("long")
    def key(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: xxhash.xxh64_intdigest(t.encode()) - (1 << 63))

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(text, parts):
            out, at = [], 0
            for s in sorted(parts, key=lambda s: (s["start"], s["kind"])):
                if s["start"] >= at:
                    out += [text[at : s["start"]], "" if s["kind"] == 4 and s["share"] >= REMOVED else f"[{KINDS[s['kind']].upper()}]"]
                    at = s["end"]
            return "".join([*out, text[at:]])

        return pd.Series([t if t is None else one(t, p) for t, p in zip(texts, spans, strict=True)])

    columns = docs.columns
    keyed = docs.withColumn("__key", key(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    out = keyed.join(found, keyed["__key"] == found["text_key"], "left").withColumn("text", replaced("text", "__spans"))
    return out.select(*columns)
