import hashlib
import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import charts, cluster_scores, metrics, profile, ranks, sampling
from panelkit.operators.quantiles import exact_quantiles


def frame(n=3000, seed=1):
    g = np.random.default_rng(seed)
    heavy = np.where(g.random(n) < 0.34, 7.0, g.normal(size=n) * 1e6)  # one value holds a third
    small = g.integers(0, 20, n).astype(float)
    gaps = np.where(g.random(n) < 0.2, np.nan, g.exponential(size=n))
    return pd.DataFrame({"id": np.arange(n), "h": heavy, "s": small, "g": gaps, "k": g.choice(["a", "a", "b"], n)})


@pytest.fixture(scope="module")
def data(spark):
    pdf = frame()
    df = spark.createDataFrame(pdf).replace(float("nan"), None).persist()
    return pdf, df


PROBS = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


def test_quantiles_by_ranges_equal_the_direct_ones(data):
    pdf, df = data
    direct = exact_quantiles(df, ["h", "s", "g"], PROBS)
    ranged = exact_quantiles(df, ["h", "s", "g"], PROBS, direct_rows=10, range_rows=100, sample_rows=500)
    for c in ("h", "s", "g"):
        wanted = pdf[c].quantile(PROBS).tolist()
        assert direct.found[(), c] == pytest.approx(wanted, rel=1e-12)
        assert ranged.found[(), c] == pytest.approx(wanted, rel=1e-12)


def test_grouped_quantiles_by_ranges(data):
    pdf, df = data
    ranged = exact_quantiles(df, ["h", "g"], [0.1, 0.5], ["k"], direct_rows=10, range_rows=100, sample_rows=500)
    for k, part in pdf.groupby("k"):
        assert ranged.found[(k,), "g"] == pytest.approx(part["g"].quantile([0.1, 0.5]).tolist(), rel=1e-12)
        assert ranged.found[(k,), "h"] == pytest.approx(part["h"].quantile([0.1, 0.5]).tolist(), rel=1e-12)


def test_pearson_and_describe(data):
    pdf, df = data
    got = {(r.column_a, r.column_b): r.correlation for r in profile.correlation(df, ["h", "s", "g"]).collect()}
    wanted = pdf[["h", "s", "g"]].corr()
    for a, b in got:
        assert got[a, b] == pytest.approx(wanted.loc[a, b], abs=1e-10)
    row = profile.describe(df, ["g"]).first()
    d = pdf["g"].describe()
    assert [row["count"], row["mean"], row["std"], row["q50"]] == pytest.approx([d["count"], d["mean"], d["std"], d["50%"]])


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)], "a double, b double")
    got = {(r.column_a, r.column_b): r.correlation for r in profile.correlation(df, ["a", "b"]).collect()}
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "b"] is None and got["b", "b"] is None


def test_rank_correlations(spark):
    pdf = frame(250, 5)
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    spearman = {(r.column_a, r.column_b): r.correlation for r in ranks.spearman(df, ["h", "s", "g"]).collect()}
    kendall = {(r.column_a, r.column_b): r.correlation for r in ranks.kendall(df, ["h", "s", "g"]).collect()}
    for a, b in itertools.combinations(["h", "s", "g"], 2):
        both = pdf[[a, b]].dropna()
        assert spearman[a, b] == pytest.approx(both.rank().corr().iloc[0, 1], abs=1e-10)
        x, y = both[a].to_numpy(), both[b].to_numpy()
        sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
        tau = (sx * sy).sum() / np.sqrt((sx**2).sum() * (sy**2).sum())
        assert kendall[a, b] == pytest.approx(tau, abs=1e-10) and kendall[b, a] == kendall[a, b]


def test_rank_is_exact(spark):
    df = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN 'big' ELSE 'small' END AS y")
    got = sampling.with_rank(df, "id", 42, ["y"]).toPandas()
    import hashlib

    got["key"] = [hashlib.md5(f"{i}|42".encode()).hexdigest() for i in got["id"]]
    for _, part in got.groupby("y"):
        assert part.sort_values(["key", "id"])["rank"].tolist() == list(range(1, len(part) + 1))


def test_samples_have_exact_size_at_any_depth(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' ELSE 'common' END AS y")
    wide = sorted(r.id for r in sampling.sample_rows(df, "id", 777).collect())
    monkeypatch.setattr(sampling, "FEW_KEYS", 2)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    deep = sorted(r.id for r in sampling.sample_rows(df, "id", 777).collect())
    assert len(wide) == 777 and wide == deep
    assert sampling.sample_rows(df, "id", 99999).count() == 3000
    split = sampling.stratified_split(df, "id", "y", 0.2).where("is_test").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in split} == {"rare": 60, "common": 540}
    assert sampling.random_split(df, "id", 0.2).where("is_test").count() == 600


def test_folds_are_balanced(spark):
    df = spark.range(1003).selectExpr("id", "id % 7 AS g", "CASE WHEN id % 5 = 0 THEN 'a' ELSE 'b' END AS y")
    counts = sampling.stratified_folds(df, "id", "y", 4).groupBy("y", "fold").count().toPandas()
    for _, part in counts.groupby("y"):
        assert len(part) == 4 and part["count"].max() - part["count"].min() <= 1
    grouped = sampling.stratified_folds(df, "id", "y", 4, group_col="g")
    assert grouped.select("g", "fold").distinct().count() == 7


def scores(spark, pairs):
    df = spark.createDataFrame(pairs, "y string, p string")
    return df, {(r["class"], r["metric"]): r["value"] for r in metrics.classification_report(df, "y", "p").collect()}


def test_metrics_on_odd_predictions(spark):
    _, perfect = scores(spark, [("a", "a"), ("b", "b")])
    assert perfect["macro avg", "f1_score"] == 1.0 and perfect["accuracy", "accuracy"] == 1.0
    _, wrong = scores(spark, [("a", "b"), ("b", "a")])
    assert wrong["macro avg", "f1_score"] == 0.0
    df, odd = scores(spark, [("a", "a"), ("a", "c"), ("b", "a")])  # b never predicted, c never true
    assert odd["b", "precision"] == 0.0 and odd["c", "recall"] == 0.0 and odd["c", "support"] == 0.0
    assert odd["macro avg", "recall"] == pytest.approx(0.5 / 3)
    assert odd["weighted avg", "precision"] == pytest.approx((0.5 * 2 + 0) / 3)
    cells = {(r.actual, r.predicted): r["count"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert len(cells) == 9 and cells["b", "b"] == 0 and cells["a", "c"] == 1


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "a double")
    assert [tuple(r) for r in charts.histogram(df, ["a"]).collect()] == [("a", 0, 5.0, 2)]


def test_silhouette_matches_brute_force(spark):
    g = np.random.default_rng(2)
    x, y = g.normal(size=(200, 3)), g.choice(["a", "b", "c"], 200)
    y[0] = "single"
    df = spark.createDataFrame([(i, str(k), *map(float, r)) for i, (k, r) in enumerate(zip(y, x))], "id long, k string, a double, b double, c double")
    away = ((x[:, None] - x[None]) ** 2).sum(-1)
    total = []
    for i in range(200):
        same = (y == y[i]) & (np.arange(200) != i)
        if not same.any():
            total.append(0.0)
            continue
        near = min(away[i][y == k].mean() for k in set(y) if k != y[i])
        own = away[i][same].mean()
        total.append((near - own) / max(near, own))
    assert cluster_scores.silhouette(df, "k", ["a", "b", "c"]).first()[0] == pytest.approx(np.mean(total))




@pytest.mark.parametrize(("tile_rows", "sample"), [(2_000, None), (7, None), (30, 60)])
def test_euclidean_silhouette_matches_brute_force(spark, tile_rows, sample):
    """Also with clusters of one row, equal points in two clusters, and rows that are left out."""
    g = np.random.default_rng(4)
    x, y = g.normal(size=(150, 3)).round(1), g.choice(["a", "b", "c"], 150)
    y[0], x[1:40] = "single", x[1]
    rows = [(i, str(k), *map(float, r)) for i, (k, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame([*rows, (900, None, 1.0, 1.0, 1.0), (901, "a", None, 1.0, 1.0)], "id long, k string, a double, b double, c double").repartition(3)
    order = sorted(range(150), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[:sample]
    x, y = x[order], y[order]
    away, total = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), []
    for i in range(len(x)):
        same = (y == y[i]) & (np.arange(len(x)) != i)
        near = min(away[i][y == k].mean() for k in set(y) if k != y[i])
        own = away[i][same].mean() if same.any() else 0.0
        total.append((near - own) / max(near, own) if same.any() and max(near, own) > 0 else 0.0)
    got = cluster_scores.euclidean_silhouette(df, "k", ["a", "b", "c"], "id", sample, tile_rows=tile_rows).first()[0]
    assert got == pytest.approx(np.mean(total))


def test_silhouettes_of_one_cluster(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "id long, k string, a double")
    assert cluster_scores.euclidean_silhouette(df, "k", ["a"], "id").first()[0] is None
    assert cluster_scores.euclidean_silhouette(df.limit(0), "k", ["a"], "id").first()[0] is None
    two = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "a", 1.0)], "id long, k string, a double")
    assert cluster_scores.euclidean_silhouette(two, "k", ["a"], "id").first()[0] == 0.0


def test_category_bars_are_ranked_over_all_ranges(spark):
    """Many categories, ties, one that holds a third of the rows, a column without values."""
    g = np.random.default_rng(3)
    values = [None if x < 0.1 else "hot" if x < 0.43 else f"v{int(v)}" for x, v in zip(g.random(4000), g.integers(0, 1500, 4000))]
    df = spark.createDataFrame([(v, None, i % 3) for i, v in enumerate(values)], "a string, none string, b int").repartition(6)
    got = charts.category_bars(df, ["a", "none", "b"])
    assert got.columns == ["column", "value", "count", "position"]
    sizes = {"a": Counter(v for v in values if v is not None), "b": Counter(str(i % 3) for i in range(4000))}
    wanted = {
        (c, v, n, place)
        for c, own in sizes.items()
        for place, (v, n) in enumerate(sorted(own.items(), key=lambda item: (-item[1], item[0])), 1)
    }
    assert set(map(tuple, got.collect())) == wanted
    assert charts.category_bars(df.limit(0), ["a"]).count() == 0


@pytest.mark.parametrize("held", [0, 4_000_000])
def test_spearman_reads_its_table_once(spark, monkeypatch, held):
    """Ranks by joins of both kinds: missing cells, ties, a constant column and one that no pair can use."""
    monkeypatch.setattr(ranks, "BROADCAST_RANKS", held)
    g = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": g.integers(0, 9, 300) * 1.0, "b": g.normal(size=300), "c": 4.0, "d": g.integers(0, 50, 300) * 1.0})
    pdf.loc[g.random(300) < 0.2, "a"] = None
    pdf.loc[pdf["a"].notna(), "e"] = pdf["b"] - pdf["a"]
    pdf["f"] = [1.0] + [None] * 299
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    df = spark.createDataFrame(pdf).replace(float("nan"), None).withColumn("b", seen.asNondeterministic()("b"))
    found = {(r.column_a, r.column_b): r.correlation for r in ranks.spearman(df, list("abcdef")).collect()}
    assert read.value == 300
    for one, other in [("a", "b"), ("a", "d"), ("b", "d"), ("a", "e"), ("b", "e"), ("e", "d")]:
        both = pdf[[one, other]].dropna()
        assert found[one, other] == found[other, one] == pytest.approx(both.rank().corr().iloc[0, 1], abs=1e-10)
    assert found["a", "c"] is None and found["b", "f"] is None and found["c", "c"] == 1.0
