"""Inputs that every operator has to take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

SYLLABLES = ["an", "er", "ing", "the", "tion", "ou", "re", "st", "ha", "ble", "ü", "né"]
#: Names that the operators give columns of their own.
CLASHING = ["n_words", "score", "spans", "fp", "key", "line", "words", "rank", "class", "bucket", "start", "length", "offset", "chunk", "toxic", "place", "first", "rep", "u", "v", "code", "dim"]


def prose(seed: int, words: int, per_line: int = 12) -> str:
    draw = random.Random(seed)
    made = ["".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + per_line]) + "." for i in range(0, words, per_line))


def awkward_rows() -> list[tuple]:
    base = prose(1, 120)
    return [
        (1, base), (1, base), (2, None), (3, ""), (None, prose(2, 60)), (None, None), (4, base + " more"), (5, "One."),
        (6, prose(3, 60_000, per_line=60_000)), (7, "   \n \n\t"), (8, "x" * 300_000), (9, prose(3, 60)),
    ]


def table(spark, rows, extra: bool = True):
    """doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves."""
    names = CLASHING if extra else []
    full = [(i, t, "en", None, None if t is None else len(t), *["?"] * len(names)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` string" for n in names)
    return spark.createDataFrame(full, schema)


def stored(spark, rows, path, parts: int = 3, extra: bool = True):
    """The table as files, as operators that read their input several times ask for."""
    where = f"{path}/documents.parquet"
    table(spark, rows, extra).repartition(parts, "text").write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)
