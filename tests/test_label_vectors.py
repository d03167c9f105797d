"""Sparse label vectors against sets of tokens."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import labels
from panelkit.spec import PanelSpec

SPEC = PanelSpec(entity="e", order=("t",), row_id="id", label="y", multilabel="m")


def test_five_thousand_labels(spark):
    pick = random.Random(2)
    cells = [(i, ", ".join(f"label {pick.randrange(5_000)}" for _ in range(8))) for i in range(4_000)]
    cells += [(9_000, ", ".join(f"label {i}" for i in range(5_000))), (9_001, None), (9_002, ""), (9_003, "label 7, and label 7")]
    df = spark.createDataFrame(cells, "id long, m string").repartition(5)
    vectors, vocabulary = labels.label_vectors(df, SPEC)
    assert vectors.columns == ["id", "label_vector"] and vocabulary == sorted(f"label {i}" for i in range(5_000))
    assert "Exchange" not in vectors._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobinPartitioning", "")
    wanted = {i: {p.strip().replace("and ", "") for p in m.split(",")} - {""} if m else set() for i, m in cells}
    for r in vectors.collect():
        assert r["label_vector"].size == 5_000 and set(r["label_vector"].values) <= {1.0}
        assert {vocabulary[i] for i in r["label_vector"].indices} == wanted[r["id"]]
    back = {(r["id"], r["label"]) for r in labels.vector_labels(vectors, "label_vector", vocabulary).collect()}
    assert back == {(i, v) for i, own in wanted.items() for v in own}


def test_labels_of_other_rows_and_none(spark):
    df = spark.createDataFrame([(1, "a, new"), (2, None)], "id long, m string")
    vectors, vocabulary = labels.label_vectors(df, SPEC, ["a", "b"])
    assert vocabulary == ["a", "b"] and {r["id"]: r["label_vector"].toArray().tolist() for r in vectors.collect()} == {1: [1, 0], 2: [0, 0]}
    empty, none = labels.label_vectors(df.where("m IS NULL"), SPEC)
    assert none == [] and [r["label_vector"].numNonzeros() for r in empty.collect()] == [0]
    assert labels.vector_labels(empty, "label_vector", none).count() == 0


def test_labels_that_are_too_many_bytes(spark, monkeypatch):
    monkeypatch.setattr(labels, "VOCABULARY_BYTES", 40)
    with pytest.raises(ValueError, match="more than 40"):
        labels.fit_vocabulary(spark.createDataFrame([("one, two, three",)], "m string"), SPEC)


def test_labels_are_found_in_one_reading_and_told_without_row_functions(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(v):
        read.add(1)
        return v

    df = spark.createDataFrame([(i, f"a{i}, b{i % 3}" if i % 4 else None) for i in range(90)], f"id long, {SPEC.multilabel} string")
    df = df.withColumn(SPEC.multilabel, seen.asNondeterministic()(SPEC.multilabel))
    vocabulary = labels.fit_vocabulary(df, SPEC)
    assert read.value == 90 and len(vocabulary) == 67 + 3
    told = labels.vector_labels(labels.label_vectors(df, SPEC, vocabulary)[0], "label_vector", vocabulary)
    assert told.columns == ["id", "label"] and told.count() == 67 * 2
    plain = spark.createDataFrame([(1, "a, b")], f"id long, {SPEC.multilabel} string")
    plan = labels.vector_labels(labels.label_vectors(plain, SPEC, ["a", "b"])[0], "label_vector", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BatchEvalPython" not in plan


def test_labels_beyond_the_bytes_of_a_list_are_a_table(spark, monkeypatch):
    """Vectors and the way back are the same where the labels stay a table; rows are told apart even if they are equal."""
    pick = random.Random(5)
    cells = [(i // 2, ", ".join(["in all", *(f"l{pick.randrange(3_000)}" for _ in range(6)), "in all"])) for i in range(1_500)]
    cells += [(9_001, None), (9_002, ""), (9_003, "and one, two"), (None, "two")]
    df = spark.createDataFrame(cells, "id long, m string").repartition(5)
    wanted, listed = labels.label_vectors(df, SPEC)
    monkeypatch.setattr(labels, "VOCABULARY_BYTES", 1_000)
    vectors, table = labels.label_vectors(df, SPEC)
    assert isinstance(table, labels.LabelTable) and table.size == len(listed) and vectors.columns == wanted.columns
    assert [r["label"] for r in table.table.orderBy("place").collect()] == listed
    told = lambda t: sorted(t.collect(), key=repr)
    assert told(vectors) == told(wanted) and len(cells) == vectors.count()
    assert vectors.schema["label_vector"].dataType == wanted.schema["label_vector"].dataType
    assert told(labels.vector_labels(vectors, "label_vector", table)) == told(labels.vector_labels(wanted, "label_vector", listed))
