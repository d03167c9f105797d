import pytest
from pyspark.sql import functions as F

from panelkit.functions import blank_placeholders, duration_months, label_tokens, numeric_text
from panelkit.operators import clean, features, labels
from panelkit.spec import PanelSpec, Ratio


def values(spark, cells, expression):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r["v"] for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_dirty_numbers(spark):
    cells = ["28_", "__10000__", "_", "", " 5 ", "1d", "1e3", "0x10", "nan", "inf", "-500", None, "+5", ".5", "5.", "1e999", "2F", "1 2"]
    wanted = [28, 10000, None, None, 5, None, 1000, None, None, None, -500, None, 5, 0.5, 5, None, None, None]
    assert values(spark, cells, numeric_text) == wanted


def test_durations(spark):
    cells = ["22 Years and 1 Months", "3 Years", "7 Months", "soon", "x Years and 2 Months", None]
    assert values(spark, cells, duration_months) == [265, 36, 7, 0, None, None]


def test_label_tokens(spark):
    cells = [None, "A", "A, A, and B", "A, and B", "A,", "Brand new, X", " , "]
    wanted = [[], ["A"], ["A", "A", "B"], ["A", "B"], ["A"], ["Brnew", "X"], []]
    assert values(spark, cells, label_tokens) == wanted


def test_placeholders_match_the_whole_cell(spark):
    got = values(spark, ["_", "_x", "!@9#%8", "__"], lambda c: blank_placeholders(c, ("_", "!@9#%8")))
    assert got == [None, "_x", None, "__"]


SPEC = PanelSpec(
    entity="e", order=("t",), row_id="t", label="y", bounds={"a": (0, 10)}, lower_only={"b": 0},
    multilabel="m", multilabel_prefix="L_", ratios=(Ratio("r", "a", "b"),), placeholders=("_",), trim=(0.25, 0.75),
)


def test_bounds_are_inclusive_and_keep_null(spark):
    df = spark.createDataFrame([(0.0, -1.0), (10.0, 0.0), (10.5, None), (None, 5.0)], "a double, b double")
    out = clean.apply_lower_bounds(clean.apply_bounds(df, SPEC), SPEC).collect()
    assert [tuple(r) for r in out] == [(0.0, None), (10.0, 0.0), (None, None), (None, 5.0)]


def test_trim_is_strict(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "a double")
    assert [r.a for r in clean.trim_percentiles(df, SPEC).collect()] == [None, 1.0, 2.0, 3.0, None]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        clean.clean_data(spark.range(1), SPEC, "other")


def test_ratio_with_denominator_minus_one_is_null(spark):
    df = spark.createDataFrame([(4.0, 1.0), (4.0, -1.0), (None, 1.0)], "a double, b double")
    assert [r.r for r in features.add_ratios(df, SPEC).collect()] == [2.0, None, None]


def test_label_columns(spark):
    df = spark.createDataFrame([(1, "A, and B b"), (2, None), (3, "A, A")], "t int, m string")
    out, found = labels.encode_multilabel(df, SPEC)
    assert found == ["A", "B b"]
    assert sorted(map(tuple, out.select("t", "L_A", "L_B_b").collect())) == [(1, 1, 1), (2, 0, 0), (3, 1, 0)]
    same, none = labels.encode_multilabel(df.drop("m"), SPEC)
    assert none is None and same.columns == ["t"]
