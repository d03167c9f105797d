"""Line dedup across the corpus by a deletion-neighbourhood join, in DataFrame operations only.

Lines are sequences of units: words, or characters where a line has few words. Two lines of one kind are within the bound of
one edit if and only if they are equal after deleting at most one unit from each, at the same place; so a line emits one
hashed key for every deletion, and one for every place where another line may have a unit more, and equal keys meet. Only
lines that agree with a different line on their first or last units can be within the bound, which is asked first. What
meets is verified on the units. A line goes if an earlier line of the corpus is equal or within the bound; equal means
equal but for blanks at its ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved

MIN_WORDS = 10  # lines of fewer words are compared by characters: one word of them is too much of the line
MIN_CHARS = 5  # below, one character is more than a fifth of the line, and only equal lines are copies
BROADCAST_KEYS = 1_000_000  # repeated line ends (8 bytes each) up to which they are broadcast; beyond, the join is shuffled
_BLOCK = 16  # units whose hashes are folded into one, and blocks into one of the next level, so that a key costs far less than the line's length


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, line_no, line) of all lines that are not blank; doc_key tells texts apart that share an id."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("doc_key"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.withColumn("line", F.trim("line")).where("line <> ''").select("doc_id", "doc_key", "line_no", "line")


def _keyed(docs: DataFrame) -> DataFrame:
    """Lines with two hashes for their identity and their place in the corpus; rows without an id come last."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no")
    return lines(docs).select("*", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"), place.alias("place"))


def _half(units: Column) -> Column:
    """How many units one of a line's ends shares with any other line within the bound, given the units of the longer line;
    of words the largest power of two."""
    half = F.floor((units - 1) / 2)
    return F.when(F.col("short"), half).otherwise(F.pow(F.lit(2), F.floor(F.log2(half)))).cast("int")


def _units(line: str, short: str) -> Column:
    return F.when(F.col(short), F.split(line, "", -1)).otherwise(F.split(line, " ", -1))


def _with_ends(rows: DataFrame) -> DataFrame:
    """Lines that can have a near copy, a row for each hash of their first and last units (for partners as long, and longer
    by one)."""
    rows = rows.withColumn("words", F.split("line", " ", -1)).withColumn("short", F.size("words") < MIN_WORDS)
    rows = rows.withColumn("n", F.when(F.col("short"), F.length("line")).otherwise(F.size("words"))).where(~F.col("short") | (F.col("n") >= MIN_CHARS))
    rows = rows.withColumn("h1", _half(F.col("n"))).withColumn("h2", _half(F.col("n") + 1))

    def ends(h: str) -> list[Column]:
        first = F.when(F.col("short"), F.xxhash64(F.lit(0), h, F.left("line", F.col(h)))).otherwise(F.xxhash64(F.lit(1), h, F.slice("words", 1, F.col(h))))
        last = F.when(F.col("short"), F.xxhash64(F.lit(2), h, F.right("line", F.col(h)))).otherwise(F.xxhash64(F.lit(3), h, F.slice("words", F.col("n") - F.col(h) + 1, F.col(h))))
        return [first, last]

    both = F.when(F.col("h1") == F.col("h2"), F.array(*ends("h1"))).otherwise(F.array(*ends("h1"), *ends("h2")))
    return rows.select("k1", "k2", "place", "short", "line", "n", F.explode(both).alias("end"))


def _candidates(docs: DataFrame) -> DataFrame:
    """(line_id, k1, k2, short, line, n, longer): distinct lines that share an end with a different line, numbered in the
    order of their first places. `longer`: a line longer by one shares it."""
    ends = _with_ends(_keyed(docs))
    shared = ends.groupBy("end").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    shared = saved(shared.where("a <> b AND n_min < n_max + 2").select("end", "n_min", "n_max"))
    if shared.count() <= BROADCAST_KEYS:
        shared = F.broadcast(shared)
    met = ends.join(shared, "end").select("k1", "k2", "place", "short", "line", "n", (F.col("n_max") > F.col("n")).alias("longer"))
    distinct = met.groupBy("k1", "k2").agg(F.min("place").alias("place"), F.max("longer").alias("longer"), F.min(F.struct("n", "short", "line")).alias("line"))
    ordered = distinct.select("k1", "k2", "place", "longer", "line.n", "line.short", "line.line").orderBy("place", "k1", "k2")
    return saved(ordered.withColumn("line_id", F.monotonically_increasing_id()).drop("place"))


def _folded(side: str, count: Column) -> Column:
    """Hash of the first `count` units of a side: whole blocks of blocks by their hash, then whole blocks, then units."""
    whole = F.floor(count / _BLOCK).cast("int")
    above = F.floor(count / (_BLOCK * _BLOCK)).cast("int")
    return F.xxhash64(
        F.slice(f"{side}_above", 1, above), F.slice(f"{side}_blocks", above * _BLOCK + 1, whole - above * _BLOCK), F.slice(side, whole * _BLOCK + 1, count - whole * _BLOCK)
    )


def _variants(found: DataFrame) -> DataFrame:
    """(key, line_id): the deletion neighbourhood of every candidate line."""
    hashed = found.select("line_id", "short", "n", "longer", F.transform(_units("line", "short"), lambda w: F.xxhash64(w)).alias("fore"))
    hashed = hashed.withColumn("back", F.reverse("fore"))

    def blocks(side: str, size: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(size / _BLOCK).cast("int"))
        return F.transform(numbers, lambda j: F.xxhash64(F.slice(side, j * _BLOCK + 1, F.lit(_BLOCK))))

    hashed = hashed.withColumns({f"{side}_blocks": blocks(side, F.col("n")) for side in ("fore", "back")})
    hashed = hashed.withColumns({f"{side}_above": blocks(f"{side}_blocks", F.col("n") / _BLOCK) for side in ("fore", "back")})
    counts = F.sequence(F.lit(0), F.col("n"))
    hashed = hashed.select(
        "line_id", "short", "n", "longer",
        F.transform(counts, lambda i: _folded("fore", i)).alias("first"),
        F.transform(counts, lambda i: _folded("back", i)).alias("last"),
    )

    def key(left: Column, at: Column) -> Column:
        """Of the `left` units around a gap at `at`."""
        return F.xxhash64("short", left, at, F.get("first", at), F.get("last", left - at))

    deleted = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: key(F.col("n") - 1, i))
    gaps = F.when(F.col("longer"), F.transform(counts, lambda i: key(F.col("n"), i))).otherwise(F.array().cast("array<bigint>"))
    return hashed.select("line_id", F.explode(F.concat(deleted, gaps)).alias("key"))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether arrays of units a and b are within one edit."""
    # the first place where they differ, from 1; 0 where they are equal
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int")
    n, m = F.size(a), F.size(b)
    rest = n + m + 1

    def same(i: Column, j: Column) -> Column:
        return F.slice(a, i, rest) == F.slice(b, j, rest)

    return (at == 0) | F.when(n == m, same(at + 1, at + 1)).when(n == m + 1, same(at + 1, at)).when(n + 1 == m, same(at, at + 1)).otherwise(False)


def near_lines(docs: DataFrame) -> DataFrame:
    """(k1, k2) of distinct lines with an earlier, different line within the bound."""
    found = _candidates(docs)
    variants = saved(_variants(found))  # read twice, and far dearer to make than to read
    # the earliest line of a key is enough: it is within the bound of all others there
    first = variants.groupBy("key").agg(F.min("line_id").alias("earlier"), F.max("line_id").alias("latest")).where("earlier < latest")
    pairs = variants.join(first.drop("latest"), "key").where("line_id > earlier").select("line_id", "earlier").distinct()
    one, other = found.select("line_id", "k1", "k2", "short", "line"), found.select(F.col("line_id").alias("earlier"), F.col("short").alias("short_before"), F.col("line").alias("line_before"))
    met = pairs.join(one, "line_id").join(other, "earlier").where("short = short_before")
    met = met.select("k1", "k2", _units("line", "short").alias("units"), _units("line_before", "short").alias("units_before"))
    checked = met.where(_one_edit(F.col("units"), F.col("units_before")))
    return checked.select("k1", "k2").distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, removed): for every text with lines to remove, their sorted numbers from 0."""
    rows = _keyed(docs).select("k1", "k2", "doc_id", "doc_key", "line_no", "place")
    firsts = rows.groupBy("k1", "k2").agg(F.min("place").alias("kept"), F.count("*").alias("copies"))
    near = near_lines(docs).withColumn("near", F.lit(True))
    decided = firsts.join(near, ["k1", "k2"], "left").where("copies > 1 OR near").select("k1", "k2", "kept", F.coalesce("near", F.lit(False)).alias("near"))
    gone = rows.join(decided, ["k1", "k2"]).where("near OR place <> kept")
    return gone.groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines) of every row; the numbers of removed lines, from 0, comma-joined.

    Null and empty texts have one blank line, which like all blank lines stays. Rows without an id come after all others,
    and their lines keep only the first of each text's. Rows that repeat id and text share their fate: they count as one
    text. An empty table gives no row; other columns are ignored.
    """
    gone = removed_lines(docs)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_key"), F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"))
    joined = rows.join(gone.withColumnsRenamed({"doc_id": "g_id", "doc_key": "g_key"}), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("doc_key") == F.col("g_key")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without the removed lines in `text`; all rows and all other columns stay as they are."""
    gone = removed_lines(docs).withColumnsRenamed({"doc_id": "__id", "doc_key": "__key", "removed": "__removed"})
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left")
    kept = F.array_join(F.filter(F.split(docs["text"].cast("string"), "\n", -1), lambda line, i: ~F.array_contains("__removed", i)), "\n")
    text = F.when(F.col("__removed").isNull(), docs["text"]).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
