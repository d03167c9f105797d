"""Operators that relate texts or vectors to each other, against plain brute force."""

import itertools
import re

import numpy as np
from cases import awkward_rows, prose, stored, table

from panelkit.llm import ann, decontaminate, line_dedup


def _shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_contained_items(spark, monkeypatch):
    items = [(i, prose(500 + i, 12 + 5 * i)) for i in range(12)] + [(20, None), (21, ""), (22, "Just three words"), (None, prose(700, 20)), (0, prose(500, 12))]
    rows = awkward_rows()
    for i, (_, text) in enumerate(items[:12]):
        words = text.split()
        rows.append((50 + i, prose(800 + i, 100) + " " + " ".join(words).upper() + "! " + prose(900 + i, 300)))
        rows.append((70 + i, prose(800 + i, 50) + " " + " ".join([*words[: len(words) - 2], "changed", words[-1]]) + " " + prose(1, 50)))
        rows.append((90 + i, " ".join(words[: len(words) // 2]) + " gap " + " ".join(words[len(words) // 2 :])))
    rows += [(120, "just THREE words"), (121, "and just three words more"), (122, prose(700, 20))]
    docs = table(spark, rows)
    listed = spark.createDataFrame([(i, t, "?", "?") for i, t in items], "item_id long, text string, doc_id string, shared string")
    held = [_shingles(t) for _, t in rows]
    wanted = []
    for (item_id, text), (number, (doc_id, _)) in itertools.product(items, enumerate(rows)):
        own = _shingles(text)
        if own and len(own & held[number]) >= 0.8 * len(own) - 1e-9:
            wanted.append((doc_id, item_id, len(own & held[number]), len(own), len(own & held[number]) / len(own)))
    assert len(wanted) > 20
    assert sorted(map(tuple, decontaminate.contained_items(docs, listed).collect()), key=repr) == sorted(wanted, key=repr)
    clean = decontaminate.decontaminate(docs, listed)
    assert clean.columns == docs.columns
    leaks = {w[0] for w in wanted}
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted((i for i, _ in rows if i not in leaks), key=repr)
    # items in several blocks give the same pairs; empty tables give none
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 300)
    assert sorted(map(tuple, decontaminate.contained_items(docs, listed).collect()), key=repr) == sorted(wanted, key=repr)
    assert decontaminate.contained_items(docs.limit(0), listed).collect() == [] == decontaminate.contained_items(docs, listed.limit(0)).collect()


def _edits(a, b):
    """Word edit distance, cut off at two."""
    if abs(len(a) - len(b)) > 1:
        return 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def _line_report(rows):
    lines = [(i is None, i, n, number, line.strip(" ")) for number, (i, t) in enumerate(rows) for n, line in enumerate((t or "").split("\n"))]
    first = {}
    for no_id, i, n, _, line in lines:
        place = (no_id, i or 0, n)
        if line and place < first.get(line, (True, 1 << 62, 1 << 62)):
            first[line] = place
    split = {line: line.split(" ") for line in first}
    long = [line for line in first if len(split[line]) >= line_dedup.MIN_WORDS]
    near = {a for a in long for b in long if first[b] < first[a] and abs(len(split[a]) - len(split[b])) < 2 and (split[a][:4] == split[b][:4] or split[a][-4:] == split[b][-4:]) and _edits(split[a], split[b]) <= 1}
    short = [line for line in first if len(split[line]) < line_dedup.MIN_WORDS and len(line) >= line_dedup.MIN_CHARS]
    near |= {a for a in short for b in short if first[b] < first[a] and _edits(a, b) <= 1}
    for number, (i, t) in enumerate(rows):
        gone = sorted(n for _, _, n, k, line in lines if k == number and line and ((i is None, i or 0, n) != first[line] or line in near))
        yield i, len((t or "").split("\n")), len(gone), ",".join(map(str, gone))


def test_lines(spark, monkeypatch):
    base = prose(5, 14, per_line=14)
    words = base.split()
    edited = [
        " ".join([*words[:3], "new", *words[4:]]), " ".join(words[1:]), " ".join([*words, "end"]), " ".join([*words[:7], "in", *words[7:]]),
        " ".join([*words[:3], "new", *words[4:9], "two", *words[10:]]), " ".join(words[::-1]), "  " + base + " ",
    ]
    rows = [*awkward_rows(), (30, "\n".join(edited[:3])), (31, base + "\n\nshort line\n" + edited[3]), (32, "short line\n" + edited[4] + "\n" + edited[4]), (33, "\n".join(edited[5:])), (34, "Short line")]
    rows += [(40 + i, " ".join([*words[:5], f"u{i}", *words[6:]])) for i in range(30)]
    # few words: by characters, a fifth of the line at most; ten words of one letter are not ten characters
    few = ["Menu one", "Menu one!", "menu one!", "enu one", "Mnu  one", "größer", "grösser", "größe", "Page 10", "Page 11", "abcd", "abce", "abcde", "abcdefghij"]
    rows += [(80 + i, line) for i, line in enumerate(few)] + [(110, "a b c d e f g h i j"), (111, "x" * 400), (112, "x" * 401), (113, "\U0001f600 four"), (114, "\U0001f601 four")]
    docs = table(spark, rows)
    wanted = sorted(_line_report(rows), key=repr)
    assert {w[0] for w in wanted if w[2]} >= {81, 82, 83, 87, 89, 112, 114} and not {w[0] for w in wanted if w[2]} & {80, 84, 85, 86, 88, 90, 91, 92, 93, 110, 111}
    assert sum(w[2] for w in wanted) > 40
    assert sorted(map(tuple, line_dedup.report(docs).collect()), key=repr) == wanted
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 0)  # the way for more keys than a broadcast takes
    monkeypatch.setattr(line_dedup, "_BLOCK", 4)
    assert sorted(map(tuple, line_dedup.report(docs).collect()), key=repr) == wanted
    kept = line_dedup.dedup(docs)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in kept.where("doc_id > 3").collect()}
    for (i, t), (j, _, _, gone) in zip(rows, _line_report(rows), strict=True):
        if i is not None and i > 3:
            assert i == j and texts[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if str(n) not in gone.split(","))
    assert {r["text"] for r in kept.where("doc_id = 2").collect()} == {None}
    assert line_dedup.report(docs.limit(0)).collect() == [] == line_dedup.dedup(docs.limit(0)).collect()


def test_lines_run_no_python(spark, capsys):
    line_dedup.report(table(spark, awkward_rows()[:3])).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_neighbours(spark, monkeypatch):
    draw = np.random.default_rng(2)
    points = draw.standard_normal((900, 24)).astype(np.float32)
    points[300:420] = points[7]  # a third of the rows may be one vector
    rows = [(i, p.tolist(), 1, "?") for i, p in enumerate(points)]
    bad = [(1000, None), (1100, [0.0] * 24), (1200, [None, *[1.0] * 23]), (1300, [float("nan")] * 24), (1400, [float("inf")] * 24), (1500, []), (None, [1.0] * 24)]
    rows += [(i, v, 1, "?") for i, v in bad] + [(100, points[5].tolist(), 2, "?"), (1600, [1.0, 2.0], 1, "?"), (1601, [1.0, 3.0], 1, "?")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string")
    asked = vectors.where("vec_id % 100 = 0")
    usable = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    queries = {}
    for i, v in usable:
        if i % 100 == 0 and (i not in queries or v.tolist() < queries[i].tolist()):
            queries[i] = v
    wanted = []
    for i, q in queries.items():
        near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in usable if j != i and len(v) == len(q))[:10]
        wanted += [(i, rank, j, s) for rank, (s, j) in enumerate(near, 1)]
    for size in (32 << 20, 400):
        monkeypatch.setattr(ann, "QUERY_BYTES", size)
        got = sorted(map(tuple, ann.nearest(vectors, asked).collect()))
        assert [g[:2] for g in got] == [w[:2] for w in sorted(wanted)]
        assert np.allclose([g[3] for g in got], [w[3] for w in sorted(wanted)], rtol=1e-12, atol=0)
        assert np.mean([g[2] == w[2] for g, w in zip(got, sorted(wanted), strict=True)]) == 1
    assert ann.nearest(vectors.limit(0), asked).collect() == [] == ann.nearest(vectors, asked.limit(0)).collect()


def test_few_vectors_are_looked_at_exactly(spark):
    """The bound spares most of the exact comparisons and loses no neighbour."""
    draw = np.random.default_rng(4)
    points, query = draw.standard_normal((4000, 64)), draw.standard_normal((1, 64))
    middle = points.mean(axis=0)
    best = ann._Best(np.array([-1]), query, middle, 10)
    seen = []
    plain = ann._distances
    ann._distances = lambda p, q: seen.append(len(p)) or plain(p, q)
    try:
        rest = points - middle
        length = np.linalg.norm(rest, axis=1)
        turned = rest / length[:, None] @ ann.rotation(64).T
        best.see(np.arange(4000), points, np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / 8)
    finally:
        ann._distances = plain
    assert sum(seen) < 2000
    assert best.found[0][1].tolist() == np.argsort(plain(points, query[0]), kind="stable")[:10].tolist()
