"""Operators on vectors that work in whole numbers, against plain brute force."""

import hashlib
from math import floor

import numpy as np
import pytest

from panelkit.llm import centroids, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, low string, v string, score string"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, "?", "?", "?", "?") for i, v, label in rows], SCHEMA)


def _points(seed, n, dim, around=12):
    """Vectors in tight bundles; a third of the rows are one vector."""
    draw = np.random.default_rng(seed)
    middle = draw.standard_normal((around, dim))
    points = middle[draw.integers(0, around, n)] + 0.2 * draw.standard_normal((n, dim))
    points[n // 3 : 2 * n // 3] = points[7]
    return points * draw.uniform(0.5, 2, (n, 1)) if seed % 2 else points


NAN, INF = float("nan"), float("inf")


def _bad(dim):
    return [(7000, None, 1), (7100, [None, *[1.0] * (dim - 1)], 1), (7200, [NAN] * dim, 1), (7300, [-INF] * dim, 1), (7400, [], 1)]


def _clusters(rows, clusters, rounds, dim):
    own = [(i, [floor(1024 * x) for x in v]) for i, v, _ in rows if v and len(v) == dim and None not in v and np.isfinite(v).all()]
    order = sorted(own, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in own]
        for k in range(len(middle)):
            mine = [v for (_, v), c in zip(own, found, strict=True) if c == k]
            if mine:
                middle[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [near(v) for _, v in own]
    total = sum(d for d, _ in found)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, k, d, sum(e for e, j in found if j == k), total, digest[k]) for (i, _), (d, k) in zip(own, found, strict=True)), key=repr)


@pytest.mark.parametrize(("n", "rounds", "block"), [(400, 10, 1024), (300, 3, 16), (5, 4, 1024), (60, 0, 1024)])
def test_centroids(spark, monkeypatch, n, rounds, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = [(i, p.tolist(), 1) for i, p in enumerate(_points(n, n, 6) if n > 12 else np.arange(6.0 * n).reshape(n, 6))]
    rows += [*_bad(6), (None, [0.5] * 6, None), (3, [0.25] * 6, 2), (3, [0.25] * 6, 2), (8000, [1.0] * 5, 1), (8001, [0.0] * 6, None)]
    got = centroids.cluster(_table(spark, rows), rounds=rounds, dim=6)
    assert sorted((tuple(r)[:-1] for r in got.collect()), key=repr) == _clusters(rows, 8, rounds, 6)


def test_centroids_of_nothing(spark):
    table = _table(spark, _bad(6))
    assert centroids.cluster(table, dim=6).collect() == []
    assert centroids.cluster(table.limit(0)).collect() == []


def test_too_large_numbers_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(_table(spark, [(1, [1e9] * 6, 1)]), dim=6).collect()
    with pytest.raises(Exception, match="too long"):
        hard_negatives.mine(_table(spark, [(1, [1e12] * 6, 1)]), _table(spark, [(1, [1e12] * 6, 1)])).collect()


def test_products_follow_the_centroids():
    """Only changed components are looked at, and the products stay exact."""
    draw = np.random.default_rng(3)
    points, middle = draw.integers(-(1 << 27), 1 << 27, (50, 64)), draw.integers(-(1 << 27), 1 << 27, (8, 64))
    change = np.zeros((8, 64), np.int64)
    change[2, [3, 60]], change[5, 1] = [-7, 1 << 26], 9
    dots = np.array([[sum(int(a) * int(b) for a, b in zip(p, c, strict=True)) for c in middle] for p in points])
    want = np.array([[sum(int(a) * int(b) for a, b in zip(p, c, strict=True)) for c in middle + change] for p in points])
    assert (centroids.moved(points, dots, change) == want).all()


def _mined(rows, anchors, dim_of=len):
    def usable(rows):
        return [(i, [floor(256 * x) for x in v], label) for i, v, label in rows if i is not None and label is not None and v and None not in v and np.isfinite(v).all()]

    asked = {}
    for i, v, label in sorted(usable(anchors), key=lambda r: (r[0], r[1], r[2])):
        asked.setdefault(i, (v, label))
    out = []
    for i, (v, label) in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, w, other in usable(rows) if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            hard = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k, _) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hard_negatives(spark, monkeypatch, seed):
    draw = np.random.default_rng(seed)
    rows = [(i, p.tolist(), int(draw.integers(0, 4))) for i, p in enumerate(_points(seed, 600, 8))]
    rows += [*_bad(8), (None, [1.0] * 8, 1), (7500, [1.0] * 8, None), (7600, [0.0] * 8, 1), (7601, [0.0] * 8, 2), (7602, [0.0] * 8, 1), (300, [0.5] * 8, 3)]
    rows += [(7700, [1.0, 2.0], 1), (7701, [1.0, 2.5], 1), (7702, [1.0, 2.2], 2), (7800, [1e4] * 8, 1), (7801, [0.9e4] * 8, 1), (7802, [0.85e4] * 8, 2), (7801, [0.9e4] * 8, 1)]
    anchors = [r for r in rows if r[0] is not None and r[0] % 100 == 0]
    wanted = _mined(rows, anchors)
    assert len(wanted) > 30 and any(w[0] == 7700 for w in wanted) and any(w[0] == 7600 for w in wanted) and any(w[0] == 7800 for w in wanted)
    table, asked = _table(spark, rows), _table(spark, anchors)
    assert sorted(map(tuple, hard_negatives.mine(table, asked).collect())) == wanted
    # a small sample, small blocks of rows and several blocks of anchors give the same
    for name, value in {"SAMPLE": 40, "BLOCK": 16, "_SLICE": 3, "QUERY_BYTES": 500}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    assert sorted(map(tuple, hard_negatives.mine(table, asked).collect())) == wanted
    assert hard_negatives.mine(table.limit(0), asked).collect() == [] == hard_negatives.mine(table, asked.limit(0)).collect()


def test_bounds_hold_and_spare_scores():
    """Every score lies within its bounds; in bundles most rows are never scored."""
    draw = np.random.default_rng(5)
    points = hard_negatives.integers(_points(9, 6000, 16, around=40), 256)
    points = points[draw.permutation(len(points))]
    own = hard_negatives.directions(points[:2000].astype(float), 16)
    rows = hard_negatives._rows(np.arange(6000), draw.integers(0, 3, 6000), points, own)
    rows.angles = rows.angles.astype(np.float32).astype(float)
    a, b = rows.angles[:40][:, None, :], rows.angles[None, :, :]
    low, high = hard_negatives.score_bounds(rows.norm[:40, None], rows.norm[None], np.abs(a - b).max(axis=2), np.minimum(a + b, 2 * np.pi - a - b).min(axis=2), rows.norm[None])
    exact = points[:40] @ points.T
    assert (low <= exact).all() and (exact <= high).all()
    order = np.lexsort((rows.angles.min(axis=1), rows.angles.argmin(axis=1)))
    rows = hard_negatives.Rows(*(x[order] for x in (rows.ids, rows.labels, rows.points, rows.norm, rows.angles)))
    search = hard_negatives.Search(rows.part(0, 20), np.arange(20), np.full(20, np.iinfo(np.int64).min), np.full(20, np.iinfo(np.int64).max), True, 5)
    search.see(rows)
    assert search.scored < 20 * 6000 / 6
