"""Operators with a trained model or an optimiser: brute force where there is one answer, else held-out accuracy and bounds."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward_rows, prose, stored, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import exchange, lm_score, packing, toxicity


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_losses(spark, tmp_path, monkeypatch):
    rows = [*[r for r in awkward_rows() if len(r[1] or "") < 100_000], *[(30 + i, prose(i % 4, 80) + prose(40 + i, 20)) for i in range(10)], (50, "the the the"), (51, "?!")]
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 5_000)
    target = spark.createDataFrame([(1,), (31,), (31,), (None,), (35,), (999,), (38,)], "doc_id long")
    got = sorted(map(tuple, lm_score.cross_entropy_difference(stored(spark, rows, tmp_path), target).collect()), key=repr)
    named = {1, 31, 35, 38}
    singles, pairs = (collections.Counter(), collections.Counter()), (collections.Counter(), collections.Counter())
    for i, text in rows:
        words = _words(text)
        for model in (0, 1) if i in named else (1,):
            singles[model].update(words)
            pairs[model].update(itertools.pairwise(words))
    known = {w for w, n in singles[1].items() if n >= lm_score.LEAST}
    wanted = []
    for i, text in rows:
        words, losses = _words(text), []
        for model in (0, 1):
            mine = model == 1 or i in named
            one = collections.Counter(words if mine else [])
            two = collections.Counter(itertools.pairwise(words) if mine else [])
            everything = singles[model].total() - one.total()
            rare = sum(n for w, n in singles[model].items() if w not in known) - sum(n for w, n in one.items() if w not in known)
            loss = 0.0
            for at, word in enumerate(words):
                count = singles[model][word] - one[word] if word in known else rare
                chance = (count + lm_score.EXTRA) / (everything + lm_score.EXTRA * (len(known) + 1))
                if at and word in known and words[at - 1] in known:
                    before = words[at - 1]
                    chance = (pairs[model][before, word] - two[before, word] + lm_score.BACKING * chance) / (singles[model][before] - one[before] + lm_score.BACKING)
                loss -= math.log(chance)
            losses.append(loss / max(1, len(words)))
        wanted.append((i, len(words), losses[0], losses[1], losses[0] - losses[1]))
    wanted.sort(key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in wanted], atol=1e-9)
    assert lm_score.cross_entropy_difference(stored(spark, [], tmp_path / "none"), target).collect() == []


def test_target_like_texts_score_lower(spark, tmp_path):
    """Two languages of made-up words; the target names half of the first one's texts."""
    rows = [(i, prose(i, 150) if i % 2 else " ".join("xyz"[j % 3] * (1 + (i * j) % 5) for j in range(150))) for i in range(60)]
    target = spark.createDataFrame([(i,) for i in range(1, 30, 2)], "doc_id long")
    got = {r["doc_id"]: r["score"] for r in lm_score.cross_entropy_difference(stored(spark, rows, tmp_path), target).collect()}
    assert max(got[i] for i in range(31, 60, 2)) < min(got[i] for i in range(0, 60, 2))


def test_pieces_are_whole_and_fit(spark):
    rows = [*awkward_rows(), (60, "It's I'm, y'all've. 3.14, x.,y ., é, ñ. Σας ΑΣ <|endoftext|> <|ENDOFTEXT|> q\u0085w\x1ce ́a, ̧."), *[(100 + i, prose(i, 20 + 37 * i)) for i in range(40)]]
    got = packing.pack(table(spark, rows)).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = collections.Counter()
    for i, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            wanted[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == wanted
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()] and sum(n for _, n in parts) <= 4096
    tokens = sum(r["length"] for r in got)
    assert len(sequences) <= 1.05 * tokens / 4096 + 2
    assert packing.pack(table(spark, [])).collect() == []


@pytest.mark.parametrize("shape", ["spread", "large", "equal", "few"])
def test_patterns_place_every_piece(shape):
    draw = np.random.default_rng(5)
    sizes = {"spread": np.minimum(256, draw.lognormal(3, 1.2, 20_000).astype(int) + 1), "large": draw.integers(100, 257, 3_000), "equal": np.full(100_000, 86), "few": np.array([200, 100, 57, 3])}[shape]
    demand = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)], strict=True))
    found = packing.patterns(demand)
    placed = collections.Counter()
    for pattern, often in found:
        assert sum(c * k for c, k in pattern.items()) <= 256 and often > 0
        for c, k in pattern.items():
            placed[c] += k * often
    assert placed == demand
    if shape == "spread":
        assert sum(often for _, often in found) <= 1.005 * sizes.sum() / 256 + 1
    if shape == "equal":
        assert sum(often for _, often in found) == 50_000


def test_knapsack_is_the_best():
    draw = np.random.default_rng(6)
    size, value = np.array([2, 3, 5, 7]), draw.random(4)
    worth, counts = packing._best_pattern(value, size, 20)
    best = max(sum(k * v for k, v in zip(c, value, strict=True)) for c in itertools.product(range(11), repeat=4) if sum(k * s for k, s in zip(c, size, strict=True)) <= 20)
    assert math.isclose(worth, best) and math.isclose(counts @ value, best) and counts @ size <= 20


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, toxicity.train(docs, toxicity.training_labels(labels))


def test_held_out_accuracy(trained):
    docs, labels, _ = trained
    found = toxicity.scored(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    pdf = found.join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in pdf.doc_id) and pdf.score.between(0, 1).all()
    assert ((pdf.score >= 0.7).astype(int) == pdf.predicted).all()
    assert pdf.predicted[pdf.toxic == 0].mean() <= 0.02 and pdf.predicted[pdf.toxic == 1].mean() >= 0.75


def test_labels_that_are_held_out_change_nothing(trained, spark):
    docs, labels, model = trained
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.train(docs, toxicity.training_labels(turned))
    assert other.weights == model.weights and np.allclose(other.curve, model.curve)


@pytest.mark.parametrize("token, word", [(b"1d10t", b"idiot"), (b"i.d.i.o.t", b"idiot"), (b"m0r0n", b"moron"), (b"scuuuum", b"scum"), (b"tr@sh", b"trash"), (b"$tupid", b"stupid"), (b"l0ser", b"loser")])
def test_disguised_words_are_restored(trained, token, word):
    model = trained[2]
    assert toxicity.restore(token, model.costs) == word
    plain = model.inputs(b"thing of " + word + b" and re")
    assert model.inputs(b"thing of " + token + b" and re") == plain and plain[0] > 0
    assert model.inputs(b"thing of " + b" ".join(bytes([c]) for c in word) + b" and re") == plain
    assert model.inputs(b"thing of and re")[0] == 0


def test_restoring_is_the_cheapest_reading(trained):
    """Viterbi against all readings of short tokens."""
    costs = trained[2].costs

    def price(word):
        codes = [0, 0, 0, *(int(toxicity._CLASS[c]) for c in word), 0]
        return sum(float(costs[tuple(codes[i : i + 4])]) for i in range(len(word) + 1))

    for token in (b"1d10t", b"b4d", b"0n3", b"h3110"):
        options = [[(bytes([c]), 0.0)] if 97 <= c <= 122 else [*((bytes([x]), toxicity._SWAP_COST) for x in toxicity.LOOKALIKES[bytes([c])]), (b"", toxicity._DROP_COST + 6.0)] for c in token]
        readings = [(sum(p for _, p in parts), b"".join(x for x, _ in parts)) for parts in itertools.product(*options)]
        assert toxicity.restore(token, costs) == min((paid + price(word), word) for paid, word in readings)[1]


def test_awkward_texts_are_scored(trained, spark):
    docs, labels, model = trained
    rows = awkward_rows()
    got = toxicity.score(table(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 7)}) == 1
    assert toxicity.score(table(spark, []), model).collect() == []
    odd = spark.createDataFrame([(None, 1), (1, None), (77, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    assert toxicity.scored(table(spark, rows), odd).count() == len(rows)
    assert {r["score"] for r in toxicity.scored(table(spark, rows), odd.limit(0)).collect()} == {0.5}
    kept = toxicity.reject(table(spark, rows), odd.limit(0))
    assert kept.columns == table(spark, rows).columns and kept.count() == len(rows)
