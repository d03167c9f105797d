import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import dictionary, prep


@pytest.fixture(scope="module")
def rows(spark):
    """One value holds a third of the rows, one another tenth; some are null; one column clashes with a name of the table."""
    g = np.random.default_rng(8)
    values = [None if x < 0.05 else "hot" if x < 0.38 else "warm" if x < 0.48 else f"v{int(v)}" for x, v in zip(g.random(3000), g.zipf(1.2, 3000) % 700)]
    data = [(i, v, "abc"[int(g.integers(0, 3)) if v != "hot" else 0], i % 5, "?") for i, v in enumerate(values)]
    return spark.createDataFrame(data, "id long, value string, label string, inner_fold int, code string").repartition(4)


def test_codes_are_places_in_the_sorted_order(rows):
    held = dictionary.fit(rows, "value", ranges=7)
    known = sorted({r["value"] for r in rows.collect()} - {None})
    assert {r["value"]: r["code"] for r in held.table.collect()} == {v: i for i, v in enumerate(known)}
    assert held.size == len(known) and held.mode == "hot"
    coded = held.ordinal(rows, "place")
    assert coded.columns == [*rows.columns, "place"]
    for r in coded.collect():
        assert r["place"] == known.index(r["value"] or "hot")
    other = rows.sparkSession.createDataFrame([("new",), ("warm",), (None,)], "value string")
    assert sorted(r["place"] for r in held.ordinal(other, "place").collect()) == [-1.0, known.index("hot"), known.index("warm")]


def test_sparse_vectors(rows):
    held = dictionary.fit(rows, "value")
    codes = {r["value"]: r["code"] for r in held.table.collect()}
    other = rows.sparkSession.createDataFrame([("new",), ("warm",), (None,), ("v1",)], "value string")
    for r in held.onehot(other, "bits").collect():
        expected = [] if r["value"] == "new" else [codes[r["value"] or "hot"]]
        assert r["bits"].size == held.size and r["bits"].indices.tolist() == expected


@pytest.mark.parametrize("inner", [False, True])
def test_means_equal_those_of_the_preparation(rows, inner):
    """The same numbers as the preparation's own dictionaries give, with and without inner folds."""
    held = dictionary.fit(rows, "value", "label", "inner_fold")
    stats = prep.fit_stats(rows, [], ["value"], "label")[prep.WHOLE].prep("robust", "target")
    own = F.col("inner_fold") if inner else None
    wanted = {r["id"]: [r[f"value_{k}"] for k in "abc"] for r in stats.transform(rows, ["id"], inner=own).collect()}
    got = {r["id"]: r["means"] for r in held.target(rows, "means", own).collect()}
    assert set(got) == set(wanted)
    for i, means in wanted.items():
        assert got[i] == pytest.approx(means)


def test_columns_without_values_are_an_error(spark):
    with pytest.raises(ValueError, match="no values"):
        dictionary.fit(spark.createDataFrame([(None,)], "value string"), "value")
