"""Operators with one right answer, against plain brute force."""

import hashlib
import re

import pytest
import xxhash
from cases import awkward_rows, prose, stored, table

from panelkit.llm import exchange, licenses, pii, simhash, suffix_dedup
from panelkit.llm.components import components


def test_repeats_and_their_digests(spark, tmp_path, monkeypatch):
    """Small chunks and buckets, so that every exchange has several sides; triggers in over two chunks count as hot."""
    shared = prose(50, 40)
    rows = [*awkward_rows(), *[(100 + i, prose(200 + i, 30) + shared + prose(300 + i, 20)) for i in range(12)]]
    rows += [(i + 300, "ab" * 40) for i in range(3)] + [(400, shared[:49]), (401, shared[:50]), (402, shared[:51])]
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 4_000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 100_000)
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 3_000)
    docs = stored(spark, rows, tmp_path)
    for hot in (2, 1_000):
        monkeypatch.setattr(suffix_dedup, "HOT_CHUNKS", hot)
        got = sorted(map(tuple, suffix_dedup.digest(docs).collect()), key=repr)
        assert got == sorted(_repeats(rows), key=repr)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs).where("doc_id IN (100, 401)").collect()}
    assert kept[100] == rows[12][1].encode() and kept[401] == b""


def _repeats(rows):
    least = {}
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    for own, text in zip(order, texts, strict=True):
        for at in range(len(text) - 49):
            part = text[at : at + 50]
            least[part] = min(least.get(part, own), own)
    for (doc_id, _), own, text in zip(rows, order, texts, strict=True):
        gone = bytearray(len(text))
        for at in range(len(text) - 49):
            if least[text[at : at + 50]] < own:
                gone[at : at + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        yield doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def test_suffix_array_is_in_text_order():
    import numpy as np

    text = np.frombuffer(prose(9, 200).encode(), np.uint8)
    starts = np.arange(len(text) - 50)
    order, new = suffix_dedup.suffix_array(text, starts)
    parts = [text[s : s + 50].tobytes() for s in starts[order]]
    assert parts == sorted(parts)
    assert [True, *[a != b for a, b in zip(parts, parts[1:], strict=False)]] == new.tolist()


def test_no_documents(spark, tmp_path):
    docs = stored(spark, [], tmp_path)
    for found in (suffix_dedup.digest(docs), simhash.near_duplicates(docs), licenses.scan(docs), pii.digest(pii.find(docs)), pii.sanitise(docs)):
        assert found.collect() == []


def test_fingerprints_and_components(spark, tmp_path):
    base = prose(1, 400)
    words = base.split()
    rows = [*awkward_rows(), *[(20 + i, " ".join([*words[: 30 * i], f"edit{i}", *words[30 * i + 1 :]])) for i in range(8)], (40, "Two words"), (41, "two  WORDS")]
    got = simhash.digest(simhash.near_duplicates(stored(spark, rows, tmp_path))).collect()
    prints = [_fingerprint(t or "") for _, t in rows]
    label = {p: min((i for (i, _), q in zip(rows, prints, strict=True) if q == p and i is not None), default=None) for p in prints}
    changed = True
    while changed:
        changed = False
        for p in label:
            for q in label:
                if label[p] is not None and label[q] is not None and bin(p ^ q).count("1") <= 2 and label[q] < label[p]:
                    label[p], changed = label[q], True
        for i, p in zip([i for i, _ in rows], prints, strict=True):  # rows that share an id are one node
            for j, q in zip([i for i, _ in rows], prints, strict=True):
                if i is not None and i == j and label[q] < label[p]:
                    label[p], changed = label[q], True
    wanted = sorted(((i, f"{p:016x}", label[p]) for (i, _), p in zip(rows, prints, strict=True)), key=repr)
    assert sorted(map(tuple, got), key=repr) == wanted


def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_links_of_large_keys_are_the_same(spark, monkeypatch):
    """Many fingerprints within few bits of each other, with and without the second set of keys."""
    import numpy as np

    draw = np.random.default_rng(3)
    prints = []
    for centre in draw.integers(0, 1 << 63, 5).tolist():
        for _ in range(40):
            value = centre
            for bit in draw.choice(64, draw.integers(0, 4), replace=False).tolist():
                value ^= 1 << bit
            prints.append(value)
    prints = sorted(set(prints))
    wanted = {(a, b) for a in range(len(prints)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2}
    reps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, n) for n, p in enumerate(prints)], "fp long, rep long")

    def classes(edges):
        root = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(x) for x in range(len(prints))]

    for limit in (3, 10_000):
        monkeypatch.setattr(simhash, "LARGE_KEY", limit)
        edges = [(r["u"], r["v"]) for r in simhash.links(reps).collect()]
        assert classes(edges) == classes(wanted)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and _luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]


def _luhn(digits):
    numbers = [int(c) for c in reversed(digits)]
    return sum(n if i % 2 == 0 else sum(divmod(2 * n, 10)) for i, n in enumerate(numbers)) % 10 == 0


@pytest.mark.parametrize(
    "text",
    ["a@b@c.de x@y", "a.b@c-d.e.f@g.h", "é@b.co, ü1.2.3.4.5.6.7.8", "300.1.1.1 0001.2.3.4 1.2.3", "4485 4190 6118 7462 4485-4190-6118-7462 44854190611874621111222",
     "+1 (274) 555-9629 +12 +1..............1 +123456789012345678", "@@ .@a.b %@x.y-z.", "1" * 400 + ".1.1.1", "5@5.5.5.5 +1 555 123 4567@x.org"],
)
def test_patterns(text):
    wanted = sorted((m.start(), k, m.end()) for k, (_, pattern, right) in enumerate(BASE) for m in re.finditer(pattern, text) if right(m[0]))
    assert pii.base_spans(text) == wanted


def test_terms_that_disclose(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pii, "MIN_BITS", 4.0)  # in so small a corpus nothing is worth more
    rows = [(2000 + i, f"{w} Zorblax {w} at joe@foo.com about {w}") for i, w in enumerate(["alpha", "beta", "gamma", "delta", "omega"])]
    rows += [(10 + i, f"word {c}{c}{c} about {c}{c}{c} writes") for i, c in enumerate("abcdefghijklmnop")]
    rows += [(100 + i, f"call +1 (20{i % 10}) 555-{1000 + i} now") for i in range(800)] + awkward_rows()
    docs = stored(spark, rows, tmp_path)
    got = {(r["doc_id"], r["n_term"]): r for r in pii.digest(pii.find(docs)).collect()}
    for i in range(5):
        found = next(r for (d, _), r in got.items() if d == 2000 + i)
        start = rows[i][1].index("Zorblax")
        assert f"term:{start}:{start + 7}" in found["spans"] and "email" in found["spans"] and found["n_email"] == 1
    assert all(r["n_term"] == 0 for (d, _), r in got.items() if d is not None and 10 <= d < 100)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "Zorblax" not in clean[2000] and "[EMAIL]" in clean[2000] and clean[100] == "call [PHONE] now" and clean[2] is None
    assert pii.sanitise(docs).columns == docs.columns
    # copies of one passage are one context: they make nothing telling
    copies = stored(spark, [(i, "Quux knows ann@bar.com well") for i in range(50)] + [(99, "Quux alone")], tmp_path / "copies")
    assert pii.digest(pii.find(copies)).agg({"n_term": "sum"}).first()[0] == 0


def test_license_places_and_spans(spark):
    text = "x Licensed under CC BY-NC 4.0. Released under the MIT license; GNU general\npublic LICENSE and apache license, cc by cc by"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "mit license"), (4, "the mit of license " * 20_000), (5, "permission is hereby granted free of charge to any one")]
    got = {(r["doc_id"]): r for r in licenses.scan(table(spark, rows)).collect()}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    places = [i for i in range(len(words)) for p, _ in licenses.BASE_PHRASES if words[i : i + len(p.split())] == p.split()]
    one = got[1]
    assert (one["n_words"], one["n_base"], one["first_word"], one["last_word"]) == (len(words), len(places), min(places), max(places))
    assert one["base_labels"] == "apache,cc-by,gpl,mit" and one["labels"] == "apache,cc-by,cc-by-nc,gpl,mit" and one["score"] == 1.0
    assert (got[2]["n_words"], got[2]["labels"], got[2]["score"], got[2]["first_word"]) == (0, "", 0.0, None)
    assert got[None]["base_labels"] == "mit" and got[4]["n_base"] == 0 and got[5]["labels"] == ""


def test_matching_statistics():
    sequences = [[1, 2, 3, 4, 2, 3], [2, 3, 5, 5], [4, 2]]
    automaton = licenses.SuffixAutomaton(sequences)
    text = [2, 3, 4, 2, 3, 5, 5, 9, 1, 2, 3, 5]
    pieces = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    longest = [max((n for n in range(1, e + 1) if tuple(text[e - n : e]) in pieces), default=0) for e in range(1, len(text) + 1)]
    wanted = [(e, n) for e, n in enumerate(longest, 1) if n >= 2 and (e == len(text) or longest[e] <= n)]
    assert [(e, n) for e, n, _ in automaton.matches(text, 2)] == wanted
    for end, length, state in automaton.matches(text, 2):
        part = tuple(text[end - length : end])
        assert automaton.ends[state] == sorted((k, e) for k, s in enumerate(sequences) for e in range(1, len(s) + 1) if tuple(s[max(0, e - length) : e]) == part)
