"""Operators do their whole job: no cap on what counts, no text left aside, no row taken for another."""

import numpy as np
import pytest
from cases import prose, stored
from pyspark.sql import functions as F

from panelkit.llm import decontaminate, lm_score, pii, similar, toxicity


def test_every_target_document_counts(spark, tmp_path, monkeypatch):
    """A cap of two target documents, should one come back, must not change the losses."""
    docs = stored(spark, [(i, prose(i % 6, 80)) for i in range(24)], tmp_path)
    target = spark.createDataFrame([(i,) for i in range(0, 24, 2)], "doc_id long")
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 2_000)
    wanted = sorted(map(tuple, lm_score.cross_entropy_difference(docs, target).collect()))
    monkeypatch.setattr(lm_score, "TARGET_DOCS", 2, raising=False)
    got = sorted(map(tuple, lm_score.cross_entropy_difference(docs, target).collect()))
    assert len(got) == 24 and np.allclose(got, wanted)


def test_rows_without_ids_are_told_apart(spark, tmp_path):
    item = prose(900, 30)
    leak, clean = prose(1, 50) + " " + item, [prose(i, 60) for i in range(2, 6)]
    rows = [(None, leak), (None, clean[0]), (None, clean[0] + " "), (7, leak), (7, clean[1]), (None, clean[2]), (8, clean[2]), (9, clean[3])]
    docs = stored(spark, rows, tmp_path)
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted((r for r in rows if r[1] != leak), key=repr)
    once = similar.keep_one(kept.where(F.col("text") != "")).select("doc_id").collect()
    assert sorted((r["doc_id"] for r in once), key=repr) == [7, 8, 9, None]
    copies = stored(spark, [(None, prose(3, 60))] * 5 + [(None, prose(4, 60))], tmp_path / "copies")
    assert similar.keep_one(copies).count() == 2


def test_frequent_entities_have_disclosing_terms(spark, tmp_path):
    """Two addresses make up the entities of a small corpus; each has a word that stands nowhere else."""
    names = {"anna@example.org": "zephyrine", "bela@example.org": "quillfeather"}
    rows = [(10 * k + i, f"{prose(50 * k + i, 12)} {word} {mail} common {prose(50 * k + i + 20, 12)}") for k, (mail, word) in enumerate(names.items()) for i in range(8)]
    rows += [(100 + i, f"{prose(300 + i, 6)} common {prose(400 + i, 6)}") for i in range(80)]
    got = {r["term"]: r["share"] for r in pii.disclosing_terms(stored(spark, rows, tmp_path)).collect()}
    assert all(got.get(pii._hash(word)) == 1.0 for word in names.values())
    assert pii._hash("common") not in got


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    return toxicity.train(docs, toxicity.training_labels(labels))


@pytest.mark.parametrize("text", ["is a i d i o t", "thing " + "m o r o n " * 30, "an i" + "d" * 100 + "iot", "a.n.i.d.i.o.t", "x " + ".".join("the" * 20) + ".i.d.i.o.t"])
def test_disguised_text_of_any_length_is_decoded(model, text):
    assert model.inputs(text.encode())[0] > 0


def test_accented_words_are_restored(model):
    costs = model.costs
    assert toxicity.restored_words("un cr3tiné".encode(), costs) == ["cretiné".encode()]
    assert "crétin".encode() in toxicity.restored_words("un c.r.é.t.i.n".encode(), costs)
    assert "crétin".encode() in toxicity.restored_words("zzz c r é t i n".encode(), costs)


def _path_costs(token, costs, breaks):
    """The least cost of any reading, by plain dynamic programming over every state."""
    best = {(0, 0, 0, 0): 0.0}
    for at in range(len(token)):
        for state in [s for s in best if s[0] == at]:
            cost = best[state]
            for end, letters, price in toxicity._edges(token, at):
                context, total = state[1:], cost + price
                for letter in letters:
                    code = int(toxicity._CLASS[letter])
                    total += float(costs[*context, code])
                    context = (*context[1:], code)
                found = [(context, total)]
                if breaks and end < len(token) and context[2]:
                    found.append(((*context[1:], 0), total + float(costs[*context, 0]) + toxicity._BREAK_COST))
                for context, total in found:
                    best[end, *context] = min(total, best.get((end, *context), float("inf")))
    return min(cost + float(costs[*state[1:], 0]) for state, cost in best.items() if state[0] == len(token))


def _reading_cost(word, token, costs, breaks):
    """The least cost of one given reading: the same search, with every other character forbidden."""
    best = {(0, 0): 0.0}
    context_of = [(0, 0, 0)]
    for letter in word:
        context_of.append((*context_of[-1][1:], 0 if letter == 0x20 else int(toxicity._CLASS[letter])))
    for at in range(len(token)):
        for (place, done), cost in [item for item in best.items() if item[0][0] == at]:
            for end, letters, price in toxicity._edges(token, at):
                to, total = done, cost + price
                if word[done : done + len(letters)] != letters:
                    continue
                for letter in letters:
                    total += float(costs[*context_of[to], int(toxicity._CLASS[letter])])
                    to += 1
                found = [(to, total)]
                if breaks and end < len(token) and word[to : to + 1] == b" " and context_of[to][2]:
                    found.append((to + 1, total + float(costs[*context_of[to], 0]) + toxicity._BREAK_COST))
                for to, total in found:
                    best[end, to] = min(total, best.get((end, to), float("inf")))
    return best[len(token), len(word)] + float(costs[*context_of[-1], 0])


def test_readings_of_any_length_are_the_cheapest(model):
    """States that are left out never hold the best reading, whatever the model and the length."""
    draw = np.random.default_rng(3)
    signs = "".join(s.decode() for s in toxicity.LOOKALIKES) + "2-aabeee"
    for number in range(24):
        costs = draw.exponential(3, (32, 32, 32, 32)).astype(np.float32) if number % 2 else model.costs
        token = "".join(draw.choice(list(signs), [5, 12, 30, 120][number % 4])).encode()
        for breaks in (False, True):
            word = toxicity.restore(token, costs, breaks)
            assert abs(_reading_cost(word, token, costs, breaks) - _path_costs(token, costs, breaks)) < 1e-3


def test_long_disguises_keep_their_whole_reading(model):
    """No length at which a reading changes: a stretched word of 300,000 letters, a sentence spelt out, words without gaps."""
    assert toxicity.restored_words(b"yes " + b"i" * 300_000 + b"diot", model.costs)[0] in (b"idiot", b"iidiot")
    spelt = " ".join("you are an idiot " * 40).replace("   ", " ").encode()
    assert b"idiot" in {w for w in toxicity.restored_words(spelt, model.costs)}


def test_restored_words_count_once_per_token_before_them(model):
    head = "a long and equal beginning of many texts, well over sixty-four bytes of it "
    pairs = [list(toxicity.restored(f"{head}{left} 1d10t and {left} 1d10t".encode(), model.costs)) for left in ("red", "blue")]
    assert [left for left, word in pairs[0] if word == b"idiot"] == [b"red"] and [left for left, word in pairs[1] if word == b"idiot"] == [b"blue"]


def test_number_of_features_is_a_parameter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    marked = toxicity.training_labels(labels)
    every, few = toxicity.train(docs, marked), toxicity.train(docs, marked, features=3)
    assert len(few.weights) == 3 < len(every.weights) and few.weights.items() <= every.weights.items()
    assert min(few.weights.values()) >= max(w for f, w in every.weights.items() if f not in few.weights)
