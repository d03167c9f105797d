"""Removal of repeated runs of words, and the index it searches, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from cases import awkward_rows, prose, stored

from panelkit.llm import exchange, fm_index, substring_dedup


def _repeats(rows):
    """Every window of 20 words, looked up in a dictionary of all."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    smallest = {}
    for (i, _), own in zip(rows, words, strict=True):
        for at in range(len(own) - 19):
            window = tuple(own[at : at + 20])
            smallest[window] = min(smallest.get(window, 1 << 63), 1 << 62 if i is None else i)
    for (i, _), own in zip(rows, words, strict=True):
        gone, seen = set(), set()
        for at in range(len(own) - 19):
            window = tuple(own[at : at + 20])
            if smallest[window] < (1 << 62 if i is None else i) or window in seen:
                gone.update(range(at, at + 20))
            seen.add(window)
        kept = " ".join(w for at, w in enumerate(own) if at not in gone)
        yield i, len(own), len(gone), sum(1 for at in gone if at - 1 not in gone), kept


def _rows():
    draw = random.Random(4)
    passages = [prose(40 + i, n).replace("\n", " ") for i, n in enumerate([19, 20, 21, 33, 60, 150])]
    rows = awkward_rows()
    for i in range(60):
        parts = [prose(100 + i, draw.randint(0, 60)), draw.choice(passages), prose(200 + i % 20, 25), draw.choice(passages).replace(" ", " \t\r\n"[i % 4]), prose(300 + i, draw.randint(0, 30))]
        rows.append((draw.randint(20, 60), " ".join(parts)))
    # the same words again and again, in one document and in others; a common phrase with other words around it
    rows += [(70, " ".join(["la"] * 90)), (71, " ".join(["la"] * 30 + ["di"] + ["la"] * 40)), (72, prose(5, 60, 8) + "\n" + prose(5, 60, 8))]
    rows += [(80 + i, f"{prose(500 + i, 15)} a common phrase of some twelve words that stands in many texts {prose(600 + i, 15)}") for i in range(30)]
    rows += [(0, passages[4] + " " + passages[5]), (-5, " ".join(passages[5].split()) + " " + passages[3]), (73, "\x1c".join(passages[5].split())), (None, passages[5])]
    return rows


@pytest.mark.parametrize("hot", [1000, 4, 0])
def test_repeated_windows_go(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_PIECES", hot)
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 5_000)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 20_000)
    rows = _rows()
    wanted = sorted(_repeats(rows), key=repr)
    assert sum(w[2] for w in wanted) > 1000
    docs = stored(spark, rows, tmp_path)
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=repr) == wanted
    if hot == 1000:
        got = substring_dedup.digest(docs).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(((*w[:4], hashlib.sha256(w[4].encode()).hexdigest()) for w in wanted), key=repr)


def test_awkward_tables(spark, tmp_path):
    docs = stored(spark, [(1, None), (None, ""), (2, " \n")], tmp_path)
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=repr) == [(1, 0, 0, 0, ""), (2, 0, 0, 0, ""), (None, 0, 0, 0, "")]
    assert substring_dedup.digest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    """Lengths of matches, and the smallest number where they are as long as the depth, for patterns known and unknown."""
    draw = np.random.default_rng(seed)
    depth, alphabet = [1, 2, 3, 4, 5, 20][seed], [2, 3, 2, 4, 2, 2][seed]
    sequences = [draw.integers(0, alphabet, n) for n in [*draw.integers(0, 40, 30), 0]]
    numbers = draw.integers(0, 50, len(sequences))
    index = fm_index.FmIndex(np.concatenate(sequences), np.array([len(s) for s in sequences]), numbers, depth)
    patterns = [draw.integers(-1, alphabet + 1, n) for n in draw.integers(0, 30, 20)] + sequences[:5]
    length, least = fm_index.matching_statistics(index, np.concatenate(patterns), np.array([len(p) for p in patterns]), slice_size=7)
    held = {}
    for number, own in zip(numbers.tolist(), sequences, strict=True):
        for at in range(len(own)):
            for size in range(1, min(depth, len(own) - at) + 1):
                run = tuple(own[at : at + size].tolist())
                held[run] = min(held.get(run, 1 << 62), number)
    at = 0
    for own in patterns:
        for begin in range(len(own)):
            best = max((n for n in range(1, min(depth, len(own) - begin) + 1) if tuple(own[begin : begin + n].tolist()) in held), default=0)
            assert length[at] == best
            if best == depth:
                assert least[at] == held[tuple(own[begin : begin + depth].tolist())]
            at += 1


def test_ranks_and_size():
    draw = np.random.default_rng(1)
    symbols = draw.integers(0, 37, 1000)
    tree = fm_index.WaveletTree(symbols, 37)
    at, symbol = draw.integers(0, 1001, 300), draw.integers(0, 37, 300)
    assert tree.rank(symbol, at).tolist() == [int((symbols[:p] == s).sum()) for s, p in zip(symbol, at, strict=True)]
    assert sum(bits.words.nbytes + bits.before.nbytes for _, bits, _ in tree.levels) < 1000 * 6 * 12 / 64 + 6 * 24


def test_windows_are_judged_by_their_words():
    """Pieces that share all hashes but not their words stay apart."""
    def row(chunk, words, doc_id):
        text = (" ".join(words) + " ").encode()
        return {"chunk": chunk, "bucket": 0, "kind": 1, "a": exchange.squeeze_numbers(np.array([doc_id])), "b": exchange.squeeze(bytes([len(words) - 19])), "c": exchange.squeeze(text)}

    one = [f"w{i}" for i in range(22)]
    rows = [row(1, one, 5), row(2, [*one[:20], "x", "y"], 7), row(3, one[::-1], 9)]
    masks = [int.from_bytes(exchange.expand(r[3]), "little") for r in substring_dedup._judge_pieces(rows)]
    assert masks == [0, 1, 0]
