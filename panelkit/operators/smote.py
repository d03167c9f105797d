"""Synthetic minority rows between a row and one of its nearest neighbours of the same class."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.knn import nearest_neighbours
from panelkit.operators.sampling import _cutoffs, _up_to

NEIGHBOURS = 5


def smote(df: DataFrame, label: str, row_id: str, features: str = "features", k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """(row_id, label, features, synthetic) with every class raised to the size of the largest.

    New rows are dealt evenly over a class's rows, the remainder by hash
    order. Which neighbour and how far along are read off a hash of row and
    copy number, so a re-run or a lost executor yields the same rows.
    """
    base = df.select(row_id, label, features)
    sizes = {r[label]: r["n"] for r in base.groupBy(label).agg(F.count("*").alias("n")).collect()}
    largest = max(sizes.values(), default=0)
    needed = {c: largest - n for c, n in sizes.items() if 0 < n < largest}
    real = base.withColumn("synthetic", F.lit(False))
    if not needed:
        return real
    small = [c for c in needed if sizes[c] <= k]
    if small:
        raise ValueError(f"classes {small} have too few rows for {k} neighbours")

    kind = base.schema[row_id].dataType
    number = F.col(row_id).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(row_id)
    minority = base.where(F.col(label).isin(*needed)).select(
        F.col(label).cast("string").alias("group"), label, number.alias("id"),
        vector_to_array(features).alias("x"),
    )
    named = {str(c): n for c, n in needed.items()}
    rows = {str(c): sizes[c] for c in needed}
    # equal points share one search: a copy is its own nearest neighbour
    distinct = minority.groupBy("group", "x").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    found = nearest_neighbours(distinct.select("group", F.col("rep").alias("id"), "x"), k, seed)
    places = distinct.select("group", "rep", "copies", "x")
    known = places.join(found.withColumnRenamed("id", "rep"), ["group", "rep"], "left")

    cut: dict[str, tuple | None] = dict.fromkeys(named)
    for group, total in named.items():
        spare = total % rows[group]
        if spare:
            own = minority.where(F.col("group") == group)
            cut[group] = _cutoffs(own, "id", seed, [], lambda n, s=spare: s)[()]
    share = F.lit(0)
    for group, total in named.items():
        extra = _up_to(cut[group], "id", seed).cast("int")
        share = F.when(F.col("group") == group, F.lit(total // rows[group]) + extra).otherwise(share)
    seeds = minority.withColumn("share", share).where("share > 0")
    copies = seeds.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("share")))).drop("share")
    drawn = F.md5(F.concat_ws("|", F.col("id").cast("string"), F.col("copy").cast("string"), F.lit(str(seed))).cast("binary"))
    located = copies.join(known.select("group", "x", "rep", F.col("copies").alias("same"), "near"), ["group", "x"])
    pick = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long") % k
    # the first neighbours of a repeated point are its own copies
    place = pick - (F.col("same") - 1)
    chosen = located.select(
        label, "group", "id", "copy", "x",
        F.when(place < 0, F.col("rep")).otherwise(F.coalesce(F.get("near", place.cast("int"))["id"], F.col("rep"))).alias("other"),
        (F.conv(F.substring(drawn, 9, 8), 16, 10).cast("double") / float(2**32)).alias("gap"),
    )
    ends = places.select("group", F.col("rep").alias("other"), F.col("x").alias("end"))
    made = chosen.join(ends, ["group", "other"]).select(
        F.lit(None).cast(kind).alias(row_id),
        label,
        array_to_vector(
            F.zip_with(F.zip_with("x", "end", lambda a, b: b - a), "x", lambda step, a: a + F.col("gap") * step)
        ).alias(features),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(made)
