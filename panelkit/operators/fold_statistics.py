"""Statistics of many training sets from one count per fold.

A training set is all folds but one. Nothing here makes a row once per training set: rows are counted by their own fold, and a
set's numbers are put together from those of its folds. Moments merge by their counts, means and squared deviations; missing
cells count as the set's median without a second pass; and ranks come from one sorted list of distinct values that carries a
count per fold. So a statistic costs the same passes for any number of folds.

Missing are nulls and values that are no number. Infinite values take part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIRECT_ROWS = 500_000
RANGE_ROWS = 500_000
SAMPLE_ROWS = 20_000
EDGES = 512  # values of a sample that cut a range into bins
HELD_VALUES = 200_000  # values that a task combines at a time
ROUNDS = 12


@dataclass(frozen=True)
class Moments:
    """Count, missing cells, mean, summed squared deviations, limits of some cells."""

    n: int = 0
    missing: int = 0
    mean: float = 0.0
    squares: float = 0.0
    low: float = math.inf
    high: float = -math.inf

    def __add__(self, other: "Moments") -> "Moments":
        n, missing = self.n + other.n, self.missing + other.missing
        if not self.n or not other.n:
            known = self if self.n else other
            return Moments(n, missing, known.mean, known.squares, known.low, known.high)
        apart = other.mean - self.mean
        return Moments(
            n, missing, self.mean + apart * other.n / n, self.squares + other.squares + apart * apart * self.n * other.n / n,
            min(self.low, other.low), max(self.high, other.high),
        )

    def imputed(self, value: float) -> "Moments":
        """With every missing cell at ``value``."""
        return Moments(self.n, 0, self.mean, self.squares, self.low, self.high) + Moments(self.missing, 0, value, 0.0, value, value)


def number(column: str) -> Column:
    """A cell as a double; null where it is missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def ranks(n: int, p: float) -> tuple[int, int, float]:
    """The two places (from 0) between which quantile ``p`` of n values lies, and the share of the second."""
    low = math.floor(p * (n - 1))
    share = p * (n - 1) - low
    return low, low + (share > 0), share


@dataclass(eq=False)
class _Range:
    """Values of ``column`` in [lo, hi], which hold every place in ``wanted``: (set, place from 0)."""

    column: str
    wanted: set[tuple[int, int]] = field(default_factory=set)
    lo: float = -math.inf
    hi: float = math.inf
    below: np.ndarray | None = None
    inside: np.ndarray | None = None
    settled: bool = False


def medians_and_quartiles(
    df: DataFrame,
    counted: dict[str, list[Moments]],
    sets: dict[int, list[int]],
    quartiles: bool = True,
    direct_rows: int = DIRECT_ROWS,
    range_rows: int = RANGE_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> tuple[dict[tuple[int, str], float], dict[tuple[int, str], tuple[float, float, float]]]:
    """Per (set, column): the median of the known cells, and the quartiles once missing cells are at that median.

    ``df`` has ``fold`` (0, 1, ...) and the columns; ``counted`` are the moments of each fold of a column; ``sets`` the folds of
    each training set. The median and the quartiles are read from the same list of values: missing cells stand right after the
    lower place of the median, which keeps the order, so each place with them is a place without them or is the median.
    """
    asked: dict[tuple[int, str], dict] = {}
    ranges: dict[tuple[str, object], _Range] = {}
    for c, folds in counted.items():
        # few values: one list of all of them; many: a narrow range around each wanted place
        direct = sum(m.n for m in folds) <= direct_rows
        for s, members in sets.items():
            n, missing = sum(folds[f].n for f in members), sum(folds[f].missing for f in members)
            if not n:
                continue
            places = {0.5: [ranks(n, 0.5)[0], ranks(n, 0.5)[1]]}
            for p in (0.25, 0.75) if quartiles else ():
                places[p] = [_known_place(at, places[0.5][0], missing) for at in ranks(n + missing, p)[:2]]
            asked[s, c] = places
            for p, known in places.items():
                wanted = {(s, at) for at in known if at is not None}
                if wanted:
                    ranges.setdefault((c, "all" if direct else p), _Range(c)).wanted.update(wanted)
    if not ranges:
        return {}, {}
    width = len(next(iter(counted.values())))
    for r in ranges.values():
        r.below = np.zeros(width, dtype=np.int64)
        r.inside = np.array([m.n for m in counted[r.column]], dtype=np.int64)
        r.settled = (r.column, "all") in ranges
    for attempt in range(ROUNDS):
        wide = [r for r in ranges.values() if not r.settled and r.inside.sum() > range_rows]
        if not wide:
            break
        _narrow(df, wide, sets, width, sample_rows, attempt)
    values = _at_places(df, list(ranges.values()), sets, width)
    place_of = {key: i for i, key in enumerate(ranges)}
    medians, boxes = {}, {}
    for (s, c), places in asked.items():
        def value(p: float, at: int) -> float:
            return values[place_of[c, "all" if (c, "all") in place_of else p], s, at]

        folds = [counted[c][f] for f in sets[s]]
        n, missing = sum(m.n for m in folds), sum(m.missing for m in folds)
        medians[s, c] = median = _between(*[value(0.5, at) for at in places[0.5]], ranks(n, 0.5)[2])
        if quartiles:
            ends = [
                _between(*[median if at is None else value(p, at) for at in places[p]], ranks(n + missing, p)[2]) for p in (0.25, 0.75)
            ]
            boxes[s, c] = ends[0], median, ends[1]
    return medians, boxes


def _between(a: float, b: float, share: float) -> float:
    return a + (b - a) * share if share else a


def _known_place(at: int, low: int, missing: int) -> int | None:
    """The place among known cells of a place among all cells; None for a missing cell."""
    if at <= low:
        return at
    return None if at <= low + missing else at - missing


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Folds, and each further column with NaN for a missing cell."""
    fold, *cells = batch.columns
    return fold.to_numpy(zero_copy_only=False).astype(np.int64), [c.to_numpy(zero_copy_only=False).astype(float) for c in cells]


def _narrow(df: DataFrame, wide: list[_Range], sets: dict[int, list[int]], width: int, sample_rows: int, seed: int) -> None:
    """Shrinks the ranges: values of a sample cut them into bins, and one pass counts all rows by bin and fold.

    A bin is one of the edges itself or lies between two of them, so a value that many rows have is a bin of its own.
    The counts say which bins hold the wanted places; the sample only steers how many rows these have.
    """
    parts = {(r.column, r.lo, r.hi): r for r in wide}  # the quartiles and the median of a column begin with the same range
    number_of = {part: i for i, part in enumerate(parts)}
    columns = list(dict.fromkeys(c for c, _, _ in parts))
    bounds = [(columns.index(c), lo, hi) for c, lo, hi in parts]
    drawn = [
        F.when(number(c).between(lo, hi), F.struct(F.lit(i).alias("part"), number(c).alias("v")))
        for i, (c, lo, hi) in enumerate(parts)
    ]
    fraction = min(1.0, sample_rows / min(int(r.inside.sum()) for r in parts.values()))
    seen = df.sample(fraction, seed).select(F.inline(F.array_compact(F.array(*drawn)))).toArrow()
    own, v = seen.column("part").to_numpy(), seen.column("v").to_numpy()
    edges = [_picked(v[own == i]) for i in range(len(parts))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(width * (2 * len(e) + 1), dtype=np.int64) for e in edges]
        for batch in batches:
            fold, cells = _cells(batch)
            for total, e, (at, lo, hi) in zip(totals, edges, bounds):
                held = (cells[at] >= lo) & (cells[at] <= hi)
                x = cells[at][held]
                bins = 2 * np.searchsorted(e, x)
                bins += np.append(e, np.nan)[bins // 2] == x
                total += np.bincount(fold[held] * (2 * len(e) + 1) + bins, minlength=len(total))
        for i, total in enumerate(totals):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at), pa.array(total[at])], ["part", "at", "n"])

    counts = df.select("fold", *[number(c) for c in columns]).mapInArrow(count, "part int, at long, n long")
    # at most EDGES * 2 + 1 rows per part and fold
    found = counts.groupBy("part", "at").agg(F.sum("n").alias("n")).toArrow()
    part, at, n = (found.column(c).to_numpy() for c in ("part", "at", "n"))
    for r in wide:
        i = number_of[r.column, r.lo, r.hi]
        e = edges[i]
        table = np.zeros(width * (2 * len(e) + 1), dtype=np.int64)
        table[at[part == i]] = n[part == i]
        table = table.reshape(width, -1)
        bins = [int(np.searchsorted(r.below[sets[s]].sum() + table[sets[s]].sum(axis=0).cumsum(), rank, side="right")) for s, rank in r.wanted]
        first, last, before = min(bins), max(bins), r.inside.sum()
        if first % 2:
            lo = float(e[first // 2])
        else:
            lo = float(np.nextafter(e[first // 2 - 1], np.inf)) if first else r.lo
        if last % 2:
            hi = float(e[last // 2])
        else:
            hi = float(np.nextafter(e[last // 2], -np.inf)) if last < 2 * len(e) else r.hi
        r.lo, r.hi = lo, hi
        r.below, r.inside = r.below + table[:, :first].sum(axis=1), table[:, first : last + 1].sum(axis=1)
        r.settled = lo == hi or (r.inside.sum() > before / 2 and seed > 2)


def _picked(values: np.ndarray) -> np.ndarray:
    """At most EDGES of the values, spread evenly over their order."""
    if not len(values):
        return np.zeros(0)
    return np.unique(np.sort(values)[np.linspace(0, len(values) - 1, EDGES).astype(int)] + 0.0)


def _at_places(df: DataFrame, ranges: list[_Range], sets: dict[int, list[int]], width: int) -> dict[tuple[int, int, int], float]:
    """The value at each (range, set, place).

    A task hands on the values inside the ranges, equal ones of a stretch of its rows as one row with a count per fold. Sorted
    by range, they are walked in batches with a running count per fold.
    """
    columns = list(dict.fromkeys(r.column for r in ranges))
    bounds = [(columns.index(r.column), r.lo, r.hi) for r in ranges]
    names = [f"n{f}" for f in range(width)]

    def combined(held: list[list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for i, pieces in enumerate(held):
            if pieces:
                # adding zero makes one value of both zeros
                distinct, which = np.unique(np.concatenate([x for x, _ in pieces]) + 0.0, return_inverse=True)
                counts = np.bincount(which * width + np.concatenate([f for _, f in pieces]), minlength=len(distinct) * width).reshape(-1, width)
                kept = [pa.array(np.full(len(distinct), i, np.int32)), pa.array(distinct), *[pa.array(counts[:, f].astype(np.int64)) for f in range(width)]]
                yield pa.RecordBatch.from_arrays(kept, ["range", "v", *names])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [[] for _ in bounds], 0
        for batch in batches:
            fold, cells = _cells(batch)
            for pieces, (at, lo, hi) in zip(held, bounds):
                inside = (cells[at] >= lo) & (cells[at] <= hi)
                if inside.any():
                    pieces.append((cells[at][inside], fold[inside]))
                    size += len(pieces[-1][0])
            if size >= HELD_VALUES:
                yield from combined(held)
                held, size = [[] for _ in bounds], 0
        yield from combined(held)

    values = df.select("fold", *[number(c) for c in columns]).mapInArrow(sift, "range int, v double, " + ", ".join(f"{n} long" for n in names))
    below = [r.below for r in ranges]
    places = [
        {s: np.array(sorted(at for own, at in r.wanted if own == s), dtype=np.int64) for s in {own for own, _ in r.wanted}} for r in ranges
    ]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        running: dict[int, np.ndarray] = {}
        for batch in batches:
            found = []
            for own_range, part in batch.groupby("range", sort=False):
                before = running.get(own_range, below[own_range])
                upto = before + part[names].to_numpy().cumsum(axis=0)
                for s, wanted in places[own_range].items():
                    start, ends = before[sets[s]].sum(), upto[:, sets[s]].sum(axis=1)
                    here = wanted[(wanted >= start) & (wanted < ends[-1])]
                    where = np.searchsorted(ends, here, side="right")
                    found += [(own_range, s, at, v) for at, v in zip(here, part["v"].to_numpy()[where])]
                running[own_range] = upto[-1]
            yield pd.DataFrame(found, columns=["range", "set", "place", "v"])

    ordered = values.repartition("range").sortWithinPartitions("range", "v")
    rows = ordered.mapInPandas(walk, "range int, set int, place long, v double").collect()
    return {(r["range"], r["set"], r["place"]): r["v"] for r in rows}


def fold_moments(rows: Sequence, columns: Sequence[str], width: int) -> dict[str, list[Moments]]:
    """Moments per column and fold from rows of (fold, c, rows, n, avg, var, min, max); c is the column's position."""
    found = {c: [Moments()] * width for c in columns}
    for r in rows:
        n = r["n"]
        found[columns[r["c"]]][r["fold"]] = (
            Moments(n, r["rows"] - n, r["avg"], r["var"] * n, r["low"], r["high"]) if n else Moments(missing=r["rows"])
        )
    return found
