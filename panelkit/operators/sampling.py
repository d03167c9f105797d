"""Seeded samples, splits and folds, identical on every run and engine.

Rows are ordered by a hash of their id. The hash is uniform, so its leading
digits cut even one class holding most rows into equal buckets: exact ranks
need no single big sort, and exact sample sizes need no sort at all.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions import hash_bucket, sample_key
from panelkit.spec import MAX_CLASSES

DIGITS = 3
FEW_KEYS = 50_000


def with_rank(df: DataFrame, row_id: str, seed: int, by: Sequence[str] = (), output: str = "rank") -> DataFrame:
    """Exact 1-based rank in hash order within ``by``.

    Rank = rows in earlier buckets + rank inside the own bucket. The bucket
    sizes are one row per (by, bucket), and join on the partitioning the
    window already has.
    """
    by = list(by)
    strata = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]
    names = [f"__by_{i}" for i in range(len(by))] + ["__bucket"]
    key = sample_key(row_id, seed)
    keyed = df.withColumn("__key", key).withColumns(
        {**{f"__by_{i}": s for i, s in enumerate(strata)}, "__bucket": hash_bucket(F.col("__key"), 4)}
    )
    own = W.partitionBy(*names).orderBy("__key", row_id)
    earlier = W.partitionBy(*names[:-1]).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    # at most 16**4 rows per stratum
    offsets = (
        df.select(*[s.alias(n) for s, n in zip(strata, names)], hash_bucket(key, 4).alias("__bucket"))
        .groupBy(*names).agg(F.count("*").alias("__rows"))
        .select(*names, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"))
    )
    return (
        keyed.withColumn("__own", F.row_number().over(own))
        .join(offsets, names)
        .withColumn(output, F.col("__offset") + F.col("__own"))
        .select(*df.columns, output)
    )


def stratified_folds(
    df: DataFrame, row_id: str, label: str, k: int, seed: int = 42, group_col: str | None = None
) -> DataFrame:
    """Adds ``fold`` 0..k-1 with class counts that differ by at most one, and ``inner_fold`` 0..4.

    With ``group_col`` all rows of one group share a fold (no stratification).
    """
    if group_col:
        share = F.conv(F.substring(sample_key(group_col, seed), 1, 8), 16, 10).cast("long")
        return df.withColumn("fold", (share % k).cast("int")).withColumn("inner_fold", (F.floor(share / k) % 5).cast("int"))
    ranked = with_rank(df, row_id, seed, [label], "__rank")
    place = F.col("__rank") - 1
    return (
        ranked.withColumn("fold", (place % k).cast("int"))
        .withColumn("inner_fold", (F.floor(place / k) % 5).cast("int"))
        .drop("__rank")
    )


def _cutoffs(
    df: DataFrame, row_id: str, seed: int, by: Sequence[str], wanted: Callable[[int], int]
) -> dict[tuple, tuple[str, object] | None]:
    """Per group, the (key, id) of the row at rank ``wanted(rows)`` in hash order.

    Radix selection: count rows per leading digits, keep the one bucket that
    holds the rank, repeat on more digits until few keys remain. Each pass
    shuffles only counts.
    """
    by = list(by)
    keyed = df.select(*by, sample_key(row_id, seed).alias("key"), F.col(row_id).alias("id"))
    totals = keyed.groupBy(*by).agg(F.count("*").alias("n")).take(MAX_CLASSES + 1)
    if len(totals) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes to split by")
    size = {tuple(r[b] for b in by): r["n"] for r in totals}
    left = {g: wanted(n) for g, n in size.items()}
    result: dict[tuple, tuple | None] = {g: None for g, take in left.items() if take <= 0}
    prefix = {g: "" for g in left if g not in result}
    digits = 0

    def in_bucket() -> Column:
        tests = []
        for group, p in prefix.items():
            same = [F.col(b).eqNullSafe(F.lit(v)) for b, v in zip(by, group)]
            test = F.startswith("key", F.lit(p))
            for s in same:
                test = test & s
            tests.append(test)
        merged = tests[0]
        for t in tests[1:]:
            merged = merged | t
        return merged

    while prefix and max(size[g] for g in prefix) > FEW_KEYS and digits < 30:
        digits += DIGITS
        counted = (
            keyed.where(in_bucket()).groupBy(*by, F.substring("key", 1, digits).alias("p")).agg(F.count("*").alias("n"))
        )
        buckets: dict[tuple, list] = {}
        for r in counted.collect():
            buckets.setdefault(tuple(r[b] for b in by), []).append((r["p"], r["n"]))
        for group in prefix:
            for p, n in sorted(buckets[group]):
                if left[group] <= n:
                    prefix[group], size[group] = p, n
                    break
                left[group] -= n
    if prefix:
        few: dict[tuple, list] = {}
        for r in keyed.where(in_bucket()).collect():
            few.setdefault(tuple(r[b] for b in by), []).append((r["key"], r["id"]))
        for group in prefix:
            result[group] = sorted(few[group])[left[group] - 1]
    return result


def _up_to(cutoff: tuple | None, row_id: str, seed: int) -> Column:
    if cutoff is None:
        return F.lit(False)
    key, last = sample_key(row_id, seed), F.lit(cutoff[0])
    return (key < last) | ((key == last) & (F.col(row_id) <= F.lit(cutoff[1])))


def sample_rows(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` pseudo-random rows (all rows if there are fewer): a filter, with no sort or shuffle of rows."""
    cut = _cutoffs(df, row_id, seed, [], lambda total: min(n, total))
    return df.where(_up_to(cut.get(()), row_id, seed))


def random_split(df: DataFrame, row_id: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly round(fraction * rows) rows are true."""
    cut = _cutoffs(df, row_id, seed, [], lambda total: int(fraction * total + 0.5))
    return df.withColumn("is_test", _up_to(cut.get(()), row_id, seed))


def stratified_split(df: DataFrame, row_id: str, label: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly round(fraction * rows) rows of every class are true."""
    cuts = _cutoffs(df, row_id, seed, [label], lambda total: int(fraction * total + 0.5))
    chosen = F.lit(False)
    for (value,), cut in cuts.items():
        chosen = F.when(F.col(label).eqNullSafe(F.lit(value)), _up_to(cut, row_id, seed)).otherwise(chosen)
    return df.withColumn("is_test", chosen)
