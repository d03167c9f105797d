"""Exact quantiles with bounded memory.

The built-in ``percentile`` keeps every distinct value of a column in one
buffer, which only suits small inputs. Beyond ``direct_rows`` values, a small
sample proposes a value range around each wanted rank, an exact count of the
whole table accepts or rejects the range, and this repeats until only a bounded
number of values lie inside; those alone are grouped and ranked. The sample
only ever proposes limits, so the answer is exact whatever it holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIRECT_ROWS = 500_000
RANGE_ROWS = 5_000_000
SAMPLE_ROWS = 100_000
GRID = 1_000
MAX_GROUPS = 1_000

Key = tuple[tuple, str]


@dataclass
class Quantiles:
    """Quantile values per (group, column), aligned with ``probs``."""

    probs: tuple[float, ...]
    group_fields: tuple[T.StructField, ...] = ()
    found: dict[Key, tuple[float | None, ...]] = field(default_factory=dict)

    def values(self) -> dict[Key, tuple[float | None, ...]]:
        return self.found

    def table(self, spark) -> DataFrame:
        """Long form: group columns, column, prob, value."""
        schema = T.StructType(
            [*self.group_fields, T.StructField("column", T.StringType()),
             T.StructField("prob", T.DoubleType()), T.StructField("value", T.DoubleType())]
        )
        rows = [
            (*group, column, float(p), v)
            for (group, column), values in self.found.items()
            for p, v in zip(self.probs, values)
        ]
        return spark.createDataFrame(rows, schema)


@dataclass
class _Range:
    """Values in [lo, hi] contain the ranks ``low`` and ``high`` of one quantile."""

    low: int
    high: int
    share: float
    size: int
    lo: float = -math.inf
    hi: float = math.inf
    below: int = 0
    settled: bool = False


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per cell: ``by``, ``c`` (the column's position) and ``v``.

    Grouped by ``c`` this aggregates map-side like a wide aggregate, but with
    one small piece of compiled code, and the final merge of different columns
    goes to different tasks.
    """
    cells = [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    return df.select(*by, F.inline(F.array(*cells)))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    counts: dict[Key, int] | None = None,
    direct_rows: int = DIRECT_ROWS,
    range_rows: int = RANGE_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> Quantiles:
    """Linearly interpolated quantiles of the non-null values, per group in ``by``.

    ``by`` is for few groups such as classes or folds; their number is checked.
    ``counts`` are the filled cells per (group, column), if already known.
    """
    by, columns, probs = tuple(by), list(columns), tuple(float(p) for p in probs)
    result = Quantiles(probs, tuple(df.schema[c] for c in by))
    if not columns:
        return result
    data = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=list(by))
    cells = long_values(data, columns, by).where(F.col("v").isNotNull())
    if counts is None:
        limit = MAX_GROUPS * len(columns)
        rows = cells.groupBy(*by, "c").agg(F.count("*").alias("n")).take(limit + 1)
        if len(rows) > limit:
            raise ValueError(f"more than {MAX_GROUPS} quantile groups")
        counts = {(tuple(r[b] for b in by), columns[r["c"]]): r["n"] for r in rows}
    groups = dict.fromkeys(g for g, _ in counts) or ({} if by else {(): None})
    sizes = {(g, c): counts.get((g, c), 0) for g in groups for c in columns}
    if max(sizes.values(), default=0) <= direct_rows:
        result.found = {key: (None,) * len(probs) for key in sizes}
        wanted = F.array(*[F.lit(p) for p in probs])
        for r in cells.groupBy(*by, "c").agg(F.percentile("v", wanted).alias("q")).collect():
            result.found[tuple(r[b] for b in by), columns[r["c"]]] = tuple(r["q"])
        return result

    ranges = {}
    for (group, c), n in sizes.items():
        for p in probs:
            if n:
                low = math.floor(p * (n - 1))
                share = p * (n - 1) - low
                ranges[group, c, p] = _Range(low + 1, low + 1 + (share > 0), share, n)
    seed = 0
    while any(not r.settled and r.size > range_rows for r in ranges.values()):
        wide = {k: r for k, r in ranges.items() if not r.settled and r.size > range_rows}
        _narrow(data, by, wide, sample_rows, seed)
        seed += 1
    at_rank = _values_at_ranks(data, by, ranges)
    for (group, c), n in sizes.items():
        values = []
        for p in probs:
            if not n:
                values.append(None)
                continue
            r = ranges[group, c, p]
            a, b = at_rank[group, c, p, r.low], at_rank[group, c, p, r.high]
            values.append(a + (b - a) * r.share)
        result.found[group, c] = tuple(values)
    return result


def with_limits(data: DataFrame, by: tuple[str, ...], limits: dict) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Adds lo<i>, hi<i> per (column, prob): literals, or one broadcast row per group (checked to be few)."""
    pairs = list(dict.fromkeys((c, p) for _, c, p in limits))
    if not by:
        added = {}
        for i, (c, p) in enumerate(pairs):
            lo, hi = limits[(), c, p]
            added |= {f"lo{i}": F.lit(float(lo)), f"hi{i}": F.lit(float(hi))}
        return data.withColumns(added), pairs
    rows = []
    for group in dict.fromkeys(g for g, _, _ in limits):
        row = list(group)
        for c, p in pairs:
            row += list(limits.get((group, c, p), (None, None)))
        rows.append(tuple(row))
    schema = T.StructType([data.schema[b] for b in by])
    for i in range(len(pairs)):
        schema = schema.add(f"lo{i}", T.DoubleType()).add(f"hi{i}", T.DoubleType())
    few = data.sparkSession.createDataFrame(rows, schema)
    return data.join(F.broadcast(few), list(by)), pairs


def _narrow(data: DataFrame, by: tuple[str, ...], wide: dict, sample_rows: int, seed: int) -> None:
    """Shrinks every range in ``wide`` that a sampled guess fits; others stay and are tried again."""
    limited, pairs = with_limits(data, by, {k: (r.lo, r.hi) for k, r in wide.items()})
    grid = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
    fraction = min(1.0, sample_rows / max(r.size for r in wide.values()))
    aggregates = []
    for i, (c, _) in enumerate(pairs):
        inside = F.when(F.col(c).between(F.col(f"lo{i}"), F.col(f"hi{i}")), F.col(c))
        aggregates += [F.percentile(inside, grid).alias(f"q{i}"), F.count(inside).alias(f"n{i}")]
    sampled = {
        tuple(r[b] for b in by): r
        for r in limited.sample(fraction, seed).groupBy(*by).agg(*aggregates).collect()
    }
    guesses = {}
    for (group, c, p), r in wide.items():
        row, i = sampled.get(group), pairs.index((c, p))
        if row is None or not row[f"n{i}"]:
            continue
        points, margin = row[f"q{i}"], 5 * math.sqrt(0.25 / row[f"n{i}"])
        first = math.floor(((r.low - r.below) / r.size - margin) * GRID)
        last = math.ceil(((r.high - r.below) / r.size + margin) * GRID)
        guesses[group, c, p] = (
            points[first] if first > 0 else r.lo, points[last] if last < GRID else r.hi
        )
    if not guesses:
        return
    limited, pairs = with_limits(data, by, guesses)
    aggregates = []
    for i, (c, _) in enumerate(pairs):
        aggregates += [
            F.count_if(F.col(c) < F.col(f"lo{i}")).alias(f"b{i}"),
            F.count_if(F.col(c).between(F.col(f"lo{i}"), F.col(f"hi{i}"))).alias(f"n{i}"),
        ]
    counted = {tuple(r[b] for b in by): r for r in limited.groupBy(*by).agg(*aggregates).collect()}
    for (group, c, p), (lo, hi) in guesses.items():
        row, i, r = counted[group], pairs.index((c, p)), wide[group, c, p]
        below, size = row[f"b{i}"], row[f"n{i}"]
        if below < r.low and r.high <= below + size:
            # no shrinking means repeated values, which grouping reduces to few rows anyway
            r.settled = lo == hi or (size > r.size / 2 and seed > 2)
            r.lo, r.hi, r.below, r.size = lo, hi, below, size


def _values_at_ranks(data: DataFrame, by: tuple[str, ...], ranges: dict) -> dict:
    """The values at the two ranks of each range.

    Rows shrink to one count per distinct value before the only shuffle, and the
    running count spans no more values than one range holds.
    """
    limited, pairs = with_limits(data, by, {k: (r.lo, r.hi) for k, r in ranges.items()})
    entries = [
        F.when(
            F.col(c).between(F.col(f"lo{i}"), F.col(f"hi{i}")),
            F.struct(F.lit(i).alias("i"), F.col(c).alias("v")),
        )
        for i, (c, _) in enumerate(pairs)
    ]
    values = (
        limited.select(*by, F.inline(F.array_compact(F.array(*entries))))
        .groupBy(*by, "i", "v").agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(W.partitionBy(*by, "i").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    wanted = [
        (*group, pairs.index((c, p)), rank - r.below)
        for (group, c, p), r in ranges.items()
        for rank in {r.low, r.high}
    ]
    schema = T.StructType([data.schema[b] for b in by]).add("i", T.IntegerType()).add("rank", T.LongType())
    ranks = data.sparkSession.createDataFrame(wanted, schema)
    hits = (
        values.withColumn("upto", upto)
        .join(F.broadcast(ranks), [*by, "i"])
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
    )
    found = {}
    for row in hits.collect():
        group, (c, p) = tuple(row[b] for b in by), pairs[row["i"]]
        found[group, c, p, row["rank"] + ranges[group, c, p].below] = row["v"]
    return found
