"""Training sets put together from folds, against numpy over the rows of each set."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import fold_statistics, prep

FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    """Missing cells, ties, a constant, a column that only fold 0 fills, values that follow the fold, a column without values."""
    g = np.random.default_rng(4)
    data = []
    for i in range(700):
        fold = int(g.integers(0, FOLDS))
        data.append((
            i, fold, float(g.normal()) if g.random() < 0.8 else None, int(g.integers(0, 4)) if g.random() < 0.5 else None, 2.5,
            float(i) if fold == 0 else None, 100.0 * fold + float(g.random()), None, "abc"[int(g.integers(0, 3))] if g.random() < 0.9 else None,
            "xy"[i % 2], i % 5,
        ))
    return spark.createDataFrame(data, "id long, fold int, a double, tied int, same double, once double, apart double, none double, t string, y string, inner_fold int").repartition(5)


NUMBERS = ["a", "tied", "same", "once", "apart", "none"]


def wanted(rows, folds):
    table = rows.toPandas()
    for s in range(folds):
        yield s, table[table["fold"] != s]


def check(stats, rows):
    for s, own in wanted(rows, FOLDS):
        known = [c for c in NUMBERS if own[c].notna().any()]
        assert stats[s].numeric == known and stats[s].dropped == [c for c in NUMBERS if c not in known]
        for c in known:
            filled = own[c].astype(float).fillna(own[c].astype(float).median())
            assert stats[s].medians[c] == own[c].astype(float).median()
            assert stats[s].moments[c] == pytest.approx((filled.mean(), filled.std(ddof=0), filled.min(), filled.max()), abs=1e-12)
            assert stats[s].quartiles[c] == pytest.approx(tuple(np.quantile(filled, [0.25, 0.5, 0.75])), abs=1e-12)


def test_numbers_of_every_training_set(rows):
    check(prep.fit_stats(rows, NUMBERS, [], folds=FOLDS), rows)


def test_numbers_by_ranges(rows, monkeypatch):
    """The way of large tables: ranges narrowed by samples and counts give the same, also where folds differ much."""
    tried = []
    narrow = fold_statistics._narrow
    monkeypatch.setattr(fold_statistics, "_narrow", lambda *given: tried.append(1) or narrow(*given))
    plain = fold_statistics.medians_and_quartiles
    monkeypatch.setattr(prep, "medians_and_quartiles", lambda *given: plain(*given, direct_rows=0, range_rows=60, sample_rows=200))
    check(prep.fit_stats(rows, NUMBERS, [], folds=FOLDS), rows)
    assert tried


def test_only_rows_around_the_wanted_places_are_listed(spark, monkeypatch):
    """A column of more than DIRECT_ROWS values is cut to bins first, whatever signs, zeros and infinities it has."""
    listed = []
    plain = fold_statistics._at_places
    monkeypatch.setattr(fold_statistics, "_at_places", lambda df, ranges, *given: listed.extend(ranges) or plain(df, ranges, *given))
    n = fold_statistics.DIRECT_ROWS + 1
    v = F.when(F.col("id") % 4 == 0, -0.0).when(F.col("id") % 1000 == 1, float("inf")).otherwise(((F.col("id") * 7919) % n).cast("double") - 1000.0)
    df = spark.range(n).select(F.floor(F.col("id") / 1000 % 2).alias("fold"), v.alias("v"))
    got = prep.fit_stats(df, ["v"], [], folds=2)
    assert sum(int(r.inside.sum()) for r in listed if r.lo != r.hi) < n / 20
    table = df.toPandas()
    for s in range(2):
        own = table["v"][table["fold"] != s]
        assert got[s].quartiles["v"] == tuple(own.quantile([0.25, 0.5, 0.75]))


def test_categories_of_every_training_set(rows):
    stats = prep.fit_stats(rows, [], ["t"], "y", folds=FOLDS)
    for s, own in wanted(rows, FOLDS):
        sizes = own["t"].value_counts()
        assert stats[s].modes["t"] == min(sizes.index, key=lambda v: (-sizes[v], v)) and stats[s].classes == ["x", "y"]
        filled = own.assign(t=own["t"].fillna(stats[s].modes["t"]))
        counts = {k: dict(g["y"].value_counts()) for k, g in filled.groupby(["t", "inner_fold"])}
        assert {k[1:]: v for k, v in stats[s].class_counts.items()} == counts


def test_one_training_set_equals_its_rows_alone(rows):
    by_folds = prep.fit_stats(rows, NUMBERS, ["t"], "y", folds=FOLDS)[1]
    alone = prep.fit_stats(rows.where("fold <> 1"), NUMBERS, ["t"], "y")[prep.WHOLE]
    assert by_folds.medians == alone.medians and by_folds.class_counts == alone.class_counts
    for c in by_folds.numeric:
        assert by_folds.moments[c] == pytest.approx(alone.moments[c], abs=1e-12) and by_folds.quartiles[c] == alone.quartiles[c]


def test_empty_tables_and_no_columns(rows):
    none = prep.fit_stats(rows.limit(0), NUMBERS, ["t"], "y", folds=FOLDS)
    assert all(not s.numeric and not s.categorical and s.dropped == [*NUMBERS, "t"] for s in none.values())
    assert prep.fit_stats(rows, [], [])[prep.WHOLE].numeric == []


def test_values_that_are_no_numbers_are_missing(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, "nan", "inf")], "x double")
    stats = prep.fit_stats(df, ["x"], [])[prep.WHOLE]
    assert stats.medians == {"x": 2.5} and stats.moments["x"][2:] == (1.0, float("inf"))


def test_too_many_counts_are_an_error(rows, monkeypatch):
    monkeypatch.setattr(prep, "MAX_COUNTS", 20)
    with pytest.raises(ValueError, match="more than 20 counts"):
        prep.fit_stats(rows, [], ["t"], "y", folds=FOLDS)
