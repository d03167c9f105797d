import json
import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from panelkit.operators import features, knn, prep, sampling, smote
from panelkit.plans import boosting, evaluate, kmeans, models, run, search, sweep, tasks

from panelkit.session import fresh_path
from panelkit.sources.panel import PANEL_SPEC, derived_panel
from panelkit.sources.sinks import save_model


def stats_of(df, numeric=(), categorical=(), label=None):
    return prep.fit_stats(df, numeric, categorical, label)[prep.WHOLE]


def test_scaling_edges(spark):
    rows = [(i, 5.0, 0.0 if i else 100.0, None, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "id int, constant double, rare double, empty double, x double")
    stats = stats_of(df, ["constant", "rare", "empty", "x"])
    assert stats.dropped == ["empty"]
    for scaler in prep.SCALERS:
        out = stats.prep(scaler).transform(df, ["id"]).orderBy("id").toPandas()
        assert (out["constant"] == 0).all() and out["rare"][0] > out["rare"][1]
    x = stats.prep("standard").transform(df, ["id"]).toPandas()["x"]
    assert x.mean() == pytest.approx(0) and x.std(ddof=0) == pytest.approx(1)
    x = stats.prep("minmax").transform(df, ["id"]).toPandas()["x"]
    assert (x.min(), x.max()) == (0.0, 1.0)


def test_category_edges(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",), ("it's",)], "c string")
    new = spark.createDataFrame([("a",), ("new",), (None,), ("it's",)], "c string")
    stats = stats_of(df, categorical=["c"])
    assert stats.modes["c"] == "a" and stats.categories["c"] == ["a", "b", "it's"]
    assert [r.c for r in stats.prep(encoder="ordinal").transform(new).collect()] == [0.0, -1.0, 0.0, 2.0]
    hot = [tuple(r) for r in stats.prep(encoder="onehot").transform(new).collect()]
    assert hot == [(1, 0, 0), (0, 0, 0), (1, 0, 0), (0, 0, 1)]


def test_wide_dictionaries_are_joined(spark, monkeypatch):
    df = spark.createDataFrame([(f"v{i:02d}",) for i in range(30)], "c string")
    wanted = [r.c for r in stats_of(df, categorical=["c"]).prep(encoder="ordinal").transform(df).collect()]
    monkeypatch.setattr(prep, "MAX_INLINE", 5)
    joined = [r.c for r in stats_of(df, categorical=["c"]).prep(encoder="ordinal").transform(df).collect()]
    assert sorted(joined) == sorted(wanted) == [float(i) for i in range(30)]


def test_unseen_category_gets_the_overall_mean(spark):
    rows = [("a", "x", i % 5) for i in range(6)] + [("b", "y", i % 5) for i in range(4)]
    stats = stats_of(spark.createDataFrame(rows, "c string, y string, inner_fold int"), categorical=["c"], label="y")
    out = stats.prep(encoder="target").transform(spark.createDataFrame([("zzz",)], "c string")).first()
    assert out["c_x"] == pytest.approx(0.6) and out["c_y"] == pytest.approx(0.4)


def test_unknown_names():
    with pytest.raises(ValueError):
        prep.check_names("other", "onehot")
    with pytest.raises(ValueError):
        prep.check_names("robust", "other")


def test_neighbours_match_brute_force(spark):
    g = np.random.default_rng(4)
    x = np.vstack([g.normal(size=(300, 3)), g.normal(size=(150, 3)) + 4])
    group = ["p"] * 200 + ["q"] * 250
    df = spark.createDataFrame([(k, i, list(map(float, r))) for i, (k, r) in enumerate(zip(group, x))], "group string, id long, x array<double>")
    # small cells and blocks, so that points visit other cells and several blocks
    got = {r["id"]: [n["id"] for n in r["near"]] for r in knn.nearest_neighbours(df, 5, cell_rows=25, block_rows=10).collect()}
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert len(got) == 450
    for i in range(450):
        peers = [j for j in range(450) if j != i and group[j] == group[i]]
        assert got[i] == sorted(peers, key=lambda j: (away[i, j], j))[:5]


def test_near_pairs_hold_the_nearest_of_every_point():
    """Few pairs are measured, far from the origin too, and rounding never decides between near ties."""
    g = np.random.default_rng(5)
    there = np.vstack([g.normal(size=(600, 6)), np.round(g.normal(size=(600, 6)))])
    for shift in (0.0, 1e6):
        x = there + shift
        row, col, away = knn._near_pairs(x[:200], x, np.arange(200), 5)
        exact = knn._distances(x[:200], x)
        assert len(row) < 200 * 60 and (away == exact[row, col]).all()
        exact[np.arange(200), np.arange(200)] = np.inf
        for i in range(200):
            own = sorted(zip(away[row == i], col[row == i]))[:5]
            assert [int(c) for _, c in own] == np.argsort(exact[i], kind="stable")[:5].tolist()
    near = exact[:, :600]
    radius = np.where(np.arange(200) % 2 == 0, np.partition(near, 4, axis=1)[:, 4], np.nan)
    row, col, away = knn._near_pairs(x[:200], x, np.arange(200), 5, radius)
    for i in range(200):
        inside = np.flatnonzero(exact[i] <= radius[i]) if i % 2 == 0 else np.argsort(exact[i], kind="stable")[:5]
        assert set(inside) <= set(col[row == i])
    # squares that overflow are measured one by one; an infinite distance is none
    with np.errstate(over="ignore", invalid="ignore"):
        row, col, away = knn._near_pairs(np.array([[1e200]]), np.array([[1e200], [-1e200], [1.001e200], [1e200]]), np.array([0]), 2)
    assert col.tolist() == [3] and away.tolist() == [0.0]


def test_smote(spark):
    g = np.random.default_rng(6)
    rows = [(i, 0.0, [float(v) for v in g.normal(size=2)]) for i in range(90)]
    rows += [(100 + i, 1.0, [float(v) for v in g.normal(size=2) + 5]) for i in range(25)]
    rows += [(200 + i, 2.0, [7.0, 7.0]) for i in range(8)]  # copies of one point
    df = spark.createDataFrame(rows, "id long, y double, x array<double>").select("id", "y", array_to_vector("x").alias("features"))
    out = smote.smote(df, "y", "id").withColumn("x", vector_to_array("features")).toPandas()
    assert out.groupby("y").size().tolist() == [90, 90, 90]
    assert (~out["synthetic"]).sum() == len(rows)
    made = np.array(out[(out.y == 1) & out.synthetic]["x"].tolist())
    real = np.array([r[2] for r in rows if r[1] == 1.0])
    for point in made:  # on the segment between two real rows
        gaps = real[:, None] - real[None]
        along = real[:, None] - point
        cross = gaps[..., 0] * along[..., 1] - gaps[..., 1] * along[..., 0]
        assert np.abs(cross[~np.eye(len(real), dtype=bool)]).min() < 1e-9
    assert all(v == [7.0, 7.0] for v in map(list, out[out.y == 2]["x"]))
    again = smote.smote(df, "y", "id").withColumn("x", vector_to_array("features")).toPandas()
    assert sorted(map(tuple, out["x"])) == sorted(map(tuple, again["x"]))


def test_ridge_is_the_closed_form(spark, monkeypatch):
    g = np.random.default_rng(8)
    x = g.normal(size=(120, 4))
    y = x @ [1.0, -2.0, 0.5, 3.0] + 7 + g.normal(size=120)
    rows = [(float(v), list(map(float, r))) for v, r in zip(y, x)]
    df = spark.createDataFrame(rows, "y double, x array<double>").select("y", array_to_vector("x").alias("features"))
    fitted = {}
    for most in (4_096, 3):
        # by normal equations to the last digits, beyond their limit by iterations
        monkeypatch.setattr(models, "NORMAL_FEATURES", most)
        fitted[most] = models.fit_ridge(df, alpha=5.0)
    centred = x - x.mean(0)
    wanted = np.linalg.solve(centred.T @ centred + 5.0 * np.eye(4), centred.T @ (y - y.mean()))
    assert fitted[4_096].coefficients.toArray() == pytest.approx(wanted, abs=1e-9)
    assert fitted[4_096].intercept == pytest.approx(y.mean() - x.mean(0) @ wanted, abs=1e-9)
    assert fitted[3].coefficients.toArray() == pytest.approx(wanted, abs=1e-5)


def test_ridge_of_constant_and_equal_columns(spark):
    """Penalised, a column that says nothing or the same as another has one solution."""
    g = np.random.default_rng(9)
    x = g.normal(size=(80, 1))
    x = np.hstack([x, x, np.full((80, 1), 3.0)])
    y = 4 * x[:, 0] + 1
    df = spark.createDataFrame([(float(v), list(map(float, r))) for v, r in zip(y, x)], "y double, x array<double>")
    found = models.fit_ridge(df.select("y", array_to_vector("x").alias("features")), alpha=2.0).coefficients.toArray()
    centred = x - x.mean(0)
    wanted = np.linalg.solve(centred.T @ centred + 2.0 * np.eye(3), centred.T @ (y - y.mean()))
    assert found == pytest.approx(wanted, abs=1e-6)


def test_boosting_learns_three_classes(spark, monkeypatch):
    g = np.random.default_rng(9)
    x = g.uniform(size=(300, 2))
    y = (x[:, 0] > 0.33).astype(int) + (x[:, 0] > 0.66).astype(int)
    rows = [(float(v), list(map(float, r))) for v, r in zip(y, x)]
    df = spark.createDataFrame(rows, "y double, x array<double>").select("y", array_to_vector("x").alias("features"))
    monkeypatch.setattr(boosting, "CUT_EVERY", 3)  # stages cross a checkpoint
    model = boosting.SoftmaxBoosting(5, 0.8, 2).fit(df, 3)
    assert len(model.stages) == 5 and all(len(stage) == 3 for stage in model.stages)
    right = model.transform(df).where("prediction = y").count()
    assert right > 285


def test_boosting_predicts_many_stages_and_loads_again(spark, tmp_path):
    """Prediction is linear in the stages: the default number answers in seconds, and a saved pipeline predicts the same."""
    g = np.random.default_rng(10)
    x = g.uniform(size=(200, 3))
    y = (x[:, 0] + x[:, 1] > 1).astype(int) + (x[:, 2] > 0.7).astype(int)
    df = spark.createDataFrame([(float(v), list(map(float, r))) for v, r in zip(y, x)], "y double, x array<double>").select("y", array_to_vector("x").alias("features"))
    short = boosting.SoftmaxBoosting(4, 0.3, 2).fit(df, 3)
    known = json.loads(short.getOrDefault(short.trees))
    known["stages"] = known["stages"] * 38
    long = boosting.SoftmaxBoostingModel()
    long._set(trees=json.dumps(known))
    started = time.time()
    assert long.transform(df).groupBy("prediction").count().count() >= 2
    assert time.time() - started < 30
    path = str(tmp_path / "pipeline")
    PipelineModel([short]).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.transform(df).select("prediction").collect() == short.transform(df).select("prediction").collect()


def test_boosting_steps_equal_spark_leaves(spark):
    """The flat trees put every row into the leaf that Spark's own trees name."""
    g = np.random.default_rng(11)
    x = g.uniform(size=(150, 2))
    df = spark.createDataFrame([(float(r[0] > 0.4), list(map(float, r))) for r in x], "y double, x array<double>").select("y", array_to_vector("x").alias("features"))
    tree = DecisionTreeRegressor(labelCol="y", leafCol="leaf", maxDepth=3).fit(df)
    flat = boosting._flat(tree, [float(i) for i in range(8)])
    for row in tree.transform(df).collect():
        at = 0
        while flat["feature"][at] >= 0:
            at = at + 1 if row["features"][flat["feature"][at]] <= flat["threshold"][at] else flat["right"][at]
        assert flat["step"][at] == row["leaf"]


def test_many_classes_and_categories(spark):
    """Nothing is left out past some number of classes or categories."""
    rows = [(i, i % 250, f"v{i % 600:03d}", float(i)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "row_id long, label int, city string, a double")
    assert evaluate.label_classes(df, "label") == list(range(250))
    fitted = prep.fit_stats(df, ["a"], ["city"])[prep.WHOLE].prep("standard", "onehot")
    made = fitted.vectors(df, ["row_id"]).orderBy("row_id").collect()
    assert len(made) == 3_000 and made[0]["features"].size == 601
    assert all(r["features"][1 + r["row_id"] % 600] == 1.0 and len(r["features"].indices) <= 2 for r in made[::97])
    assert PipelineModel(fitted.stages()).transform(spark.createDataFrame([(1, "new", None)], "row_id long, city string, a double")).first()["features"].numNonzeros() <= 1
    wide = fitted.transform(df.limit(3), ["row_id"])
    assert len(wide.columns) == 602


def test_rows_without_an_id_are_an_error(spark):
    df = spark.createDataFrame([(i if i % 10 else None, i % 2) for i in range(100)], "row_id long, label int")
    for split in (
        lambda: sampling.stratified_folds(df, "row_id", "label", 3),
        lambda: sampling.stratified_split(df, "row_id", "label"),
        lambda: sampling.random_split(df, "row_id"),
        lambda: sampling.sample_rows(df, "row_id", 10),
    ):
        with pytest.raises(Exception, match="has no row_id"):
            split().collect()


def test_depth_beyond_the_deepest_is_an_error():
    assert models._depth(None) == models._depth(30) == 30
    with pytest.raises(ValueError, match="31"):
        models._depth(31)


def test_grids():
    assert list(search.param_grid({})) == [{}] and search.format_params({}) == "{}"
    assert [search.format_params(p) for p in search.param_grid({"model__a": [1, 2], "b": [None]})] == ["a=1, b=None", "a=2, b=None"]
    assert len(list(search.param_grid(search.get_param_grid_for("RandomForest")))) == 12
    assert sum(len(list(search.param_grid(g))) for g in search.SWEEP_GRIDS.values()) * 9 == 135
    with pytest.raises(ValueError):
        models.get_models()["DecisionTree"].with_params({"C": 1})


@pytest.fixture(scope="module")
def prepared(spark, sf):
    path = fresh_path(spark, "prepared")
    features.prepare(derived_panel(spark, sf), PANEL_SPEC).write.parquet(path)
    return spark.read.parquet(path)


def test_saved_pipeline_predicts_the_same(spark, prepared):
    tree = models.ModelSpec("DecisionTree", {"max_depth": 4}, "balanced")
    held = evaluate.evaluate_holdout(prepared, PANEL_SPEC, evaluate.build_pipeline("robust", "target", tree))
    assert held.summary.first()["macro_f1"] > 0.7
    loaded = PipelineModel.load(save_model(held.pipeline, fresh_path(spark, "model")))
    again = loaded.transform(prepared).select("row_id", F.col("predicted").alias("other"))
    assert held.predictions.count() == 300
    assert held.predictions.join(again, "row_id").where("predicted <> other").count() == 0


def test_sweep_ranks_and_leaves_out_failures(prepared):
    board, top, best = sweep.run_full_sweep(
        prepared, PANEL_SPEC, scalers=["robust"], encoders=["ordinal"], models=["DecisionTree"], cv=2, top_k=1,
        param_grids={"DecisionTree": {"max_depth": [2, 4, -1]}},
    )
    rows = board.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0].macro_f1 >= rows[1].macro_f1
    assert top.count() == 1 and best["params"] == rows[0].params
    with pytest.raises(ValueError):
        sweep.run_full_sweep(prepared, PANEL_SPEC, primary_metric="other")
    empty, _, none = sweep.run_full_sweep(
        prepared, PANEL_SPEC, scalers=["robust"], encoders=["ordinal"], models=["DecisionTree"], cv=2,
        param_grids={"DecisionTree": {"max_depth": [-1]}},
    )
    assert none == {} and empty.count() == 0


def test_tasks_refuse_bad_input(prepared):
    with pytest.raises(KeyError):
        tasks.regress(prepared, PANEL_SPEC, "absent")
    with pytest.raises(ValueError):
        tasks.cluster(prepared.where("row_id < 20"), PANEL_SPEC, 4)


def test_kmeans_in_shared_passes(spark):
    """All numbers of clusters and seeds at once reach what separate fits reach, and labels follow the centres."""
    g = np.random.default_rng(6)
    middle = g.normal(scale=6, size=(5, 3))
    x = middle[g.integers(0, 5, 400)] + g.normal(size=(400, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(900, None, 1.0, 1.0)], "id long, a double, b double, c double")
    found = kmeans.fit_many(df, ["a", "b", "c"], "id", [1, 3, 5], restarts=6)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df.where("a IS NOT NULL"))
    for k, model in found.items():
        if k > 1:
            apart = min(KMeans(k=k, seed=s).fit(vectors).summary.trainingCost for s in range(3))
            assert model.inertia <= apart * 1.001
        away = ((x[:, None] - model.centres[None]) ** 2).sum(-1)
        assert model.inertia == pytest.approx(away.min(axis=1).sum())
        labels = {r["id"]: r["k"] for r in df.where("a IS NOT NULL").withColumn("k", kmeans.nearest_centre(model, ["a", "b", "c"])).collect()}
        assert [labels[i] for i in range(400)] == away.argmin(axis=1).tolist()
    assert found[1].centres[0] == pytest.approx(x.mean(axis=0))
    with pytest.raises(ValueError, match="fewer points"):
        kmeans.fit_many(df.limit(0), ["a"], "id", [2])


def test_kmeans_rests_on_shares_before_all_rows(spark, monkeypatch):
    """Most passes read a share of the rows, the last ones all; what is found is as good as without shares."""
    g = np.random.default_rng(8)
    x = g.normal(size=(3000, 2)) + g.integers(0, 3, 3000)[:, None] * 2.0
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")
    wanted = kmeans.fit_many(df, ["a", "b"], "id", [2, 4], restarts=3)
    sizes, once = [], kmeans._pass
    monkeypatch.setattr(kmeans, "START_SAMPLE", 50)
    monkeypatch.setattr(kmeans, "LEVEL", 4)
    monkeypatch.setattr(kmeans, "_pass", lambda table, models, dim: sizes.append(table.agg(F.sum(F.length("block"))).first()[0] // 16) or once(table, models, dim))
    found = kmeans.fit_many(df, ["a", "b"], "id", [2, 4], restarts=3)
    assert sizes[-1] == 3000 and sizes == sorted(sizes) and len(set(sizes)) == 2
    for k, model in found.items():
        assert model.inertia == pytest.approx(((x[:, None] - model.centres[None]) ** 2).sum(-1).min(axis=1).sum())
        assert model.inertia <= wanted[k].inertia * 1.01


def test_elbow_reads_its_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    df = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 17).cast("double").alias("a"), seen.asNondeterministic()((F.col("id") % 5).cast("double")).alias("b"))
    board = tasks.kmeans_elbow(df, PANEL_SPEC, [2, 3], features=["a", "b"], restarts=2, sample=100).collect()
    assert [r["k"] for r in board] == [2, 3] and read.value == 400


def test_a_centre_without_points_stays():
    sums, inertia = kmeans.pass_sums(np.array([[0.0], [1.0], [1.0]]), [np.array([[0.5], [0.5], [9.0]])])[0]
    assert sums.tolist() == [[3.0, 2.0], [0.0, 0.0], [0.0, 0.0]] and inertia == pytest.approx(0.75)
    same = kmeans.starting_centres(np.zeros((4, 2)), 3, 1)
    assert same.tolist() == [[0.0, 0.0]] * 3


def test_staged_run_keeps_its_table_and_its_reports_apart(spark, sf):
    options = run.RunOptions(stages=(), cv_folds=2, sample_rows=300, skip_grid=True, models={"DecisionTree": models.ModelSpec("DecisionTree", {"max_depth": 2})})
    result = run.run(derived_panel(spark, sf), PANEL_SPEC, fresh_path(spark, "run"), options)
    assert sorted(result.written) == ["confusion_matrix", "cv_baseline", "final_summary", "per_class"] and not result.failures
    assert spark.read.option("header", True).csv(result.written["cv_baseline"]).first()["model"] == "DecisionTree"


def test_trees_do_not_grow_in_more_tasks_than_cores(spark, monkeypatch):
    """Each task hands on histograms of all nodes, so the many parts of a table are put together, but not beyond a number of rows."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).repartition(64)
    assert models.tree_rows(rows).rdd.getNumPartitions() == cores and models.tree_rows(rows).count() == 1000
    assert models.tree_rows(rows.limit(0)).count() == 0
    monkeypatch.setattr(models, "TASK_ROWS", 25)
    assert models.tree_rows(rows).rdd.getNumPartitions() == 40
