"""Category dictionaries of any size: built, kept and applied as tables.

A dictionary has one row per value. Its codes are places in the sorted order of all values: values are dealt to ranges, each
range is ranked by itself, and the sizes of the ranges before it are added. Rows meet it in a join. Values that hold more than
a thousandth of all rows, of which there are at most a thousand, come as a broadcast; rows of all others are spread by value.
No list of values reaches the driver, only one size per range and one mode and count per column and class.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelkit.session import fresh_path
from panelkit.spec import MAX_CLASSES

HOT_SHARE = 1_000  # a value with more than one in so many rows is hot
WHOLE = -1


@dataclass
class Dictionary:
    """The fitted table of one column: value, code, n and, with a label, counts per class and inner fold."""

    column: str
    table: DataFrame
    rows: int
    size: int
    mode: str
    classes: list
    totals: dict  # rows per (class, inner fold)

    def overall(self, inner: int = WHOLE) -> list[float]:
        """Share of each class among the training rows, those of one inner fold left out."""
        counts = [sum(n for (k, f), n in self.totals.items() if k == own and f != inner) for own in self.classes]
        return [n / sum(counts) if sum(counts) else 0.0 for n in counts]

    def _joined(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``df`` with the dictionary's ``columns`` (null for unknown values) under names beginning with __d_."""
        names = {c: f"__d_{c}" for c in columns}
        value = F.coalesce(F.col(f"`{self.column}`").cast("string"), F.lit(self.mode))
        own = self.table.select(F.col("value").alias("__value"), "n", *[F.col(c).alias(n) for c, n in names.items()])
        limit = self.rows / HOT_SHARE
        hot = own.where(F.col("n") > limit).drop("n").withColumn("__hot", F.lit(True))
        keyed = df.withColumn("__value", value).join(F.broadcast(hot), "__value", "left")
        # rows that have found their value keep out of each other's way in the second join
        spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4_096)).cast("string"))
        keyed = keyed.withColumn("__value", F.when(F.col("__hot"), spread).otherwise(F.col("__value")))
        cold = own.where(F.col("n") <= limit).drop("n").withColumnsRenamed({n: f"__c{n}" for n in names.values()})
        met = keyed.join(cold, "__value", "left")
        return met.withColumns({n: F.coalesce(n, f"__c{n}") for n in names.values()}).drop("__value", "__hot", *[f"__c{n}" for n in names.values()])

    def ordinal(self, df: DataFrame, output: str) -> DataFrame:
        """``df`` with the value's place in the sorted order; -1 for values that training did not have. Nulls are the mode."""
        return self._joined(df, ["code"]).withColumn(output, F.coalesce("__d_code", F.lit(-1)).cast("double")).drop("__d_code")

    def onehot(self, df: DataFrame, output: str) -> DataFrame:
        """``df`` with a sparse vector of zeros and one 1; all zeros for values that training did not have."""
        coded = self._joined(df, ["code"]).withColumn("__at", F.coalesce("__d_code", F.lit(self.size)).cast("double"))
        encoder = OneHotEncoder(inputCols=["__at"], outputCols=[output], dropLast=True)
        # fitting only learns the size
        fitted = encoder.fit(df.sparkSession.createDataFrame([(float(self.size),)], "__at double"))
        return fitted.transform(coded).drop("__at", "__d_code")

    def target(self, df: DataFrame, output: str, inner: Column | None = None) -> DataFrame:
        """``df`` with an array of class means of the value, pulled to the overall means the more its rows vary and the fewer
        they are. ``inner`` names a row's inner fold, whose rows its own means leave out (-1: none)."""
        if not self.classes:
            raise ValueError("the dictionary was fitted without a label")
        own = F.lit(WHOLE) if inner is None else inner.cast("int")
        folds = sorted({f for _, f in self.totals} | {WHOLE})
        overall = F.lit(None).cast("array<double>")
        for f in folds:
            overall = F.when(F.col("__inner") == f, F.array(*[F.lit(x) for x in self.overall(f)])).otherwise(overall)
        zero = F.lit(0).cast("long")
        count = F.aggregate(F.filter("__d_counts", lambda c: c["f"] != F.col("__inner")), zero, lambda total, c: total + c["n"])

        def mean(k: int) -> Column:
            mine = F.aggregate(F.filter("__d_counts", lambda c: (c["f"] != F.col("__inner")) & (c["k"] == F.lit(self.classes[k]))), zero, lambda total, c: total + c["n"])
            base, share = F.get("__overall", F.lit(k)), mine / F.col("__n")
            spread = base * (1 - base)
            weight = F.col("__n") / (F.col("__n") + share * (1 - share) / spread)
            return F.when((F.coalesce("__n", F.lit(0)) == 0) | (spread == 0), base).otherwise(weight * share + (1 - weight) * base)

        met = self._joined(df.withColumn("__inner", own), ["counts"]).withColumn("__overall", overall).withColumn("__n", count)
        return met.withColumn(output, F.array(*[mean(k) for k in range(len(self.classes))])).drop("__inner", "__overall", "__n", "__d_counts")


def fit(df: DataFrame, column: str, label: str | None = None, inner: str | None = None, ranges: int | None = None) -> Dictionary:
    """The dictionary of ``column``; with ``label`` (and ``inner``, a column of inner folds) it can encode by class means.

    Null values count as the mode (the most frequent value, the smallest of several). A column without any value is an error.
    """
    spark = df.sparkSession
    value = F.col(f"`{column}`").cast("string")
    extra = [F.col(f"`{label}`").alias("k"), (F.col(f"`{inner}`") if inner else F.lit(0)).cast("int").alias("f")] if label else []
    names = ["k", "f"] if label else []
    path = fresh_path(spark, "counts")
    df.select(value.alias("value"), *extra).groupBy("value", *names).agg(F.count("*").alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    by_value = counts.groupBy("value").agg(F.sum("n").alias("n"))
    # one number a range: as many ranges as the cluster shuffles to
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = by_value.where("value IS NOT NULL")
    top = known.agg(F.max("n").alias("n")).first()["n"]
    if top is None:
        raise ValueError(f"{column} has no values")
    mode = known.where(F.col("n") == top).agg(F.min("value")).first()[0]
    path = fresh_path(spark, "ranges")
    known.repartitionByRange(ranges, "value").withColumn("range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = {r["range"]: r["n"] for r in dealt.groupBy("range").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for number in sorted(sizes):
        offsets.append((number, before))
        before += sizes[number]
    place = F.row_number().over(Window.partitionBy("range").orderBy("value")) - 1
    coded = dealt.join(F.broadcast(spark.createDataFrame(offsets, "range int, before long")), "range").select("value", "n", (F.col("before") + place).alias("code"))
    rows = by_value.agg(F.sum("n")).first()[0]
    classes, totals = [], {}
    if label:
        known_class = counts.where("k IS NOT NULL").withColumn("value", F.coalesce("value", F.lit(mode)))
        found = known_class.groupBy("k", "f").agg(F.sum("n").alias("n")).take(MAX_CLASSES * 100 + 1)
        classes = sorted({r["k"] for r in found})
        if len(classes) > MAX_CLASSES:
            raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
        totals = {(r["k"], r["f"]): r["n"] for r in found}
        merged = known_class.groupBy("value", "k", "f").agg(F.sum("n").alias("n"))
        listed = merged.groupBy("value").agg(F.collect_list(F.struct("k", "f", "n")).alias("counts"))
        coded = coded.join(listed, "value", "left")
    path = fresh_path(spark, "dictionary")
    coded.write.parquet(path)
    return Dictionary(column, spark.read.parquet(path), rows, before, mode, classes, totals)
