"""The stages of the corpus pipeline on a small corpus, each against what it has to do to its own input."""

import re

import pytest
from cases import awkward_rows, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from panelkit.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("corpus"))
    item = prose(900, 30)
    rows = awkward_rows()
    rows += [(100 + i, prose(i, 200)) for i in range(100, 160)]
    rows += [(300 + i, prose(i, 90) + " idiot " + prose(i + 1, 40)) for i in range(500, 530)]
    rows += [(400, prose(100, 200)), (401, prose(101, 200).replace("an", "em", 1)), (402, prose(777, 80) + " " + " ".join(item.split()) + " " + prose(778, 80))]
    spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    labels = [(i, 1, int("idiot" in (t or ""))) for i, t in rows if i and i >= 100 and i not in (400, 401, 402)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What each stage was given and what it returned, written in between."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/out-{name}")
        done = spark.read.parquet(f"{folder}/out-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()), key=repr)


def test_stages(steps):
    assert list(steps) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, (_, done) in steps.items():
        if name != "packing":
            assert done.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go(steps):
    before, after = (_rows(d) for d in steps["toxicity"])
    assert after == [r for r in before if "idiot" not in (r[1] or "")] and len(after) < len(before)


def test_repeated_lines_go(steps):
    before, after = steps["line_dedup"]
    rows = sorted(((i is None, i or 0, t, n) for i, t, n in before.select("doc_id", "text", "n_chars").collect()), key=repr)
    assert after.count() == len(rows)
    seen, first = set(), {}
    for no_id, i, t, _ in sorted(rows, key=lambda r: r[:2]):
        for n, line in enumerate((t or "").split("\n")):
            first.setdefault(line.strip(" "), (no_id, i, n))
    for r in after.where("doc_id >= 100").collect():
        for line in r["text"].split("\n"):
            assert line.strip(" ") == "" or (line.strip(" "), r["doc_id"]) not in seen
            seen.add((line.strip(" "), r["doc_id"]))
            assert line.strip(" ") == "" or first[line.strip(" ")][1] == r["doc_id"]
        assert r["n_chars"] == len(r["text"])
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    assert texts[400].strip() == "" and len(texts[401].strip()) < 10  # a copy, and one with a word changed
    assert texts[2] is None


def test_one_of_each_group_stays(steps):
    """Five-word shingles, a similarity of 0.8; texts without words are one group; rows without an id go by their texts."""
    before, after = (_rows(d) for d in steps["near_dedup"])

    def shingles(text):
        words = re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [(i, shingles(t)) for i, t in before if i is not None]
    label = {i: i for i, _ in sets}
    for _ in sets:
        for i, p in sets:
            label[i] = min(label[j] for j, q in sets if len(p & q) >= 0.8 * len(p | q) and bool(p) == bool(q))
    assert [r for r in after if r[0] is not None] == [r for r in before if r[0] is not None and label[r[0]] == r[0]]
    assert len(after) < len(before)


def test_leaks_go(steps):
    before, after = (_rows(d) for d in steps["decontamination"])
    assert after == [r for r in before if r[0] != 402] and len(after) == len(before) - 1


def test_all_documents_are_packed(steps):
    before, after = steps["packing"]
    pieces = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"), F.count("*").alias("k"))
    got = {r["doc_id"]: r for r in pieces.collect()}
    copies = {r["doc_id"]: r["n"] for r in before.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert set(got) == set(copies) and all(got[i]["n"] == got[i]["all"] * n for i, n in copies.items() if i is not None)


def test_run_equals_its_stages(spark, folder, steps):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got, wanted = corpus_pipeline.run(spark, folder), steps["packing"][1]
    assert got.columns == names and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_stages_take_empty_tables(spark, folder, tmp_path, empty):
    """No documents give no pieces; without labels nothing is toxic, without a benchmark nothing leaks."""
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        if name == "documents":
            table = table.where("doc_id BETWEEN 200 AND 203")
        (table.limit(0) if name == empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert (pieces.count() == 0) == (empty == "documents")


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
