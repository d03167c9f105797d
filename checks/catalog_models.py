"""Queries for sinks, SMOTE, models, tasks and experiments. Models are small so that a check stays short; rows never are."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import catalog as cat
from checks import sql as q
from checks.catalog import S, dom, panel, register, rounded
from panelkit.operators import features, prep, profile, smote
from panelkit.operators.prep import WHOLE
from panelkit.plans import ablations, evaluate, models, run, search, sweep, tasks
from panelkit.session import fresh_path
from panelkit.sources import files, sinks
from panelkit.streaming import clean_stream, stream_to_table

SMALL = {
    "LogisticRegression": models.ModelSpec("LogisticRegression", {"C": 1.0, "max_iter": 50}, "balanced"),
    "DecisionTree": models.ModelSpec("DecisionTree", {"max_depth": 5}, "balanced"),
    "RandomForest": models.ModelSpec("RandomForest", {"n_estimators": 10, "max_depth": 6}, "balanced"),
    "GradientBoosting": models.ModelSpec("GradientBoosting", {"n_estimators": 3, "learning_rate": 0.1}),
}
TREE = {"DecisionTree": SMALL["DecisionTree"]}


_WRITTEN: dict[tuple[str, str], str] = {}


def prepared(spark, sf):
    """The whole prepared panel, written once per session to the shared folder so that repeated fits do not redo it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _WRITTEN:
        path = fresh_path(spark, "prepared")
        features.prepare(panel(spark, sf), S).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


# --- sources and sinks ------------------------------------------------------
@register("a1_csv_scan", q.with_(**q.PANEL) + "SELECT row_id, age, occupation, monthly_salary, interest_rate, loan_types FROM panel")
def a1(spark, sf):
    columns = ["row_id", "age", "occupation", "monthly_salary", "interest_rate", "loan_types"]
    df = panel(spark, sf).select(*columns)
    path = fresh_path(spark, "csv")
    # a missing cell is written as a token that the reader must turn back into null
    df.write.option("header", True).option("nullValue", "NA").csv(path)
    return files.read_panel_csv(spark, path, df.schema)


@register("a3_report_csv", q.with_(**q.PANEL) + f"SELECT score AS class, CAST(count(*) AS VARCHAR) AS count FROM panel GROUP BY score")
def a3(spark, sf):
    path = sinks.write_report_csv(profile.target_distribution(panel(spark, sf), S.label), fresh_path(spark, "report"))
    return spark.read.option("header", True).csv(path).select("class", "count")


@register("a4_summary_json", q.with_(**q.PANEL) + "SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers FROM panel")
def a4(spark, sf):
    totals = panel(spark, sf).agg(F.count("*").alias("rows"), F.countDistinct("customer_id").alias("customers"))
    path = sinks.write_summary_json(totals.select(F.struct("rows", "customers").alias("panel")), fresh_path(spark, "summary"))
    return spark.read.schema("panel struct<rows: long, customers: long>").json(path).select("panel.*")


@register(
    "a5_saved_pipeline",
    q.with_(**q.FILLED, c="SELECT floor(0.2E0 * count(*) + 0.5E0) AS n FROM fill WHERE score IS NOT NULL GROUP BY score")
    + "SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS different FROM c",
)
def a5(spark, sf):
    """A saved and loaded pipeline gives the held-out rows the classes that the fitted one gave them."""
    df = prepared(spark, sf)
    held = evaluate.evaluate_holdout(df, S, evaluate.build_pipeline("robust", "onehot", SMALL["DecisionTree"]))
    path = sinks.save_model(held.pipeline, fresh_path(spark, "pipeline"))
    again = PipelineModel.load(path).transform(df).select("row_id", F.col("predicted").alias("loaded"))
    both = held.predictions.join(again, "row_id")
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("predicted").eqNullSafe(F.col("loaded"))).alias("different"))


@register("e11_profile_bundle")
def e11(spark, sf):
    """Every line of every report."""
    written = profile.write_eda_reports(panel(spark, sf), S, fresh_path(spark, "eda"))
    lines = [spark.read.text(path).select(F.lit(name).alias("report"), F.col("value").alias("line")) for name, path in written.items()]
    table = lines[0]
    for other in lines[1:]:
        table = table.unionByName(other)
    return table


@register("b8_restarted_stream", q.with_(**q.DOMAIN) + "SELECT row_id, age, annual_income, history_months, interest_rate, num_delayed, "
    + ", ".join(f"{q.r(f'({r.numerator} / ({r.denominator} + 1))')} AS {r.name}" for r in S.ratios) + " FROM dom")
def b8_stream(spark, sf):
    """The cleaning and the ratios on a stream of files that is stopped after its first batch and started again."""
    raw, target, progress = panel(spark, sf), fresh_path(spark, "stream-out"), fresh_path(spark, "stream-progress")
    source = fresh_path(spark, "stream-in")
    raw.repartition(6, "row_id").write.parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(source)
    cleaned = clean_stream(stream, S)
    started = stream_to_table(cleaned, target, progress)
    while started.isActive and not started.lastProgress:
        time.sleep(0.05)
    started.stop()
    stream_to_table(cleaned, target, progress).awaitTermination()
    names = ["row_id", "age", "annual_income", "history_months", "interest_rate", "num_delayed", *(r.name for r in S.ratios)]
    return rounded(spark.read.parquet(target).select(*names), only=[r.name for r in S.ratios])


# --- resampling -------------------------------------------------------------
SMOTE_COLUMNS = ["interest_rate", "num_delayed", "utilization"]


@register(
    "h3_smote_counts",
    q.with_(**q.DOMAIN, c="SELECT score, count(*) AS n FROM dom GROUP BY score")
    + "SELECT score, (SELECT max(n) FROM c) AS rows, (SELECT max(n) FROM c) - n AS synthetic FROM c",
)
def h3(spark, sf):
    df = dom(spark, sf)
    fitted = prep.fit_stats(df, SMOTE_COLUMNS, [], scalers=("robust",))[WHOLE].prep("robust")
    made = smote.smote(fitted.vectors(df, ["row_id", "score"]), "score", "row_id")
    return made.groupBy("score").agg(F.count("*").alias("rows"), F.count_if("synthetic").alias("synthetic"))


# --- models -----------------------------------------------------------------
def _holdout(spark, sf, name):
    config = evaluate.build_pipeline("robust", "onehot", SMALL[name])
    return evaluate.evaluate_holdout(prepared(spark, sf), S, config)


for _id, _name in (("i1_logistic", "LogisticRegression"), ("i2_decision_tree", "DecisionTree"), ("i3_random_forest", "RandomForest"), ("i4_boosting", "GradientBoosting")):

    @register(_id)
    def classify(spark, sf, name=_name):
        return _holdout(spark, sf, name).summary


REGRESSION_NUMBERS = ["age", "annual_income", "monthly_salary", "utilization", "emi", "invested", "num_delayed"]


def _regression_vectors(spark, sf):
    df = features.drop_missing(dom(spark, sf), ["balance"])
    fitted = prep.fit_stats(df, REGRESSION_NUMBERS, [], scalers=("robust",))[WHOLE].prep("robust")
    return fitted.vectors(df.withColumn("y", F.col("balance")), ["y"])


@register("i5_ridge")
def i5(spark, sf):
    """The coefficients of all numbers and one-hot categories, class label apart."""
    work = features.drop_missing(prepared(spark, sf), ["balance"]).drop(S.label)
    numeric, categorical = features.split_features(work, S, "balance")
    fitted = prep.fit_stats(work, numeric, categorical, scalers=("robust",))[WHOLE].prep("robust", "onehot")
    model = models.fit_ridge(fitted.vectors(work.withColumn("y", F.col("balance").cast("double")), ["y"]))
    rows = list(zip([*fitted.output_columns(), "intercept"], [float(v) for v in [*model.coefficients, model.intercept]]))
    return spark.createDataFrame(rows, "feature string, value double")


def _equations_sql() -> str:
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM d)) AS {c}" for c in REGRESSION_NUMBERS)
    tables = q.with_(**q.DOMAIN, d="SELECT * FROM dom WHERE balance IS NOT NULL", imp=f"SELECT CAST(balance AS DOUBLE) AS y, {filled} FROM d")
    width = "coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1)"
    cells = [f"SELECT '{c}' AS feature, {q.r(f'(covar_pop({c}, y) / {width.format(c=c)})', 4)} AS value FROM imp" for c in REGRESSION_NUMBERS]
    return tables + " UNION ALL ".join(cells)


@register("i5_ridge_equations", _equations_sql())
def i5_equations(spark, sf):
    """The left side of the normal equations at the fitted coefficients; only their solution gives the right side, which SQL counts."""
    vectors, alpha = _regression_vectors(spark, sf), 1.0
    model = models.fit_ridge(vectors, alpha=alpha)
    told = model.transform(vectors).select("prediction", vector_to_array("features").alias("x"))
    size = len(REGRESSION_NUMBERS)
    sums = told.agg(F.count("*").alias("n"), *[F.covar_pop(F.get("x", F.lit(i)), "prediction").alias(f"s{i}") for i in range(size)])
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.col(f"s{i}") + F.lit(alpha * float(model.coefficients[i])) / F.col("n")).alias("value"))
        for i, c in enumerate(REGRESSION_NUMBERS)
    ]
    return rounded(sums.select(F.inline(F.array(*cells))), 4)


@register("i6_boosted_regressor")
def i6(spark, sf):
    vectors = _regression_vectors(spark, sf)
    model = models.fit_boosted_regressor(vectors, n_estimators=5)
    return cat.metrics.regression_scores(model.transform(vectors), "y", "prediction")


@register("i7_kmeans")
def i7(spark, sf):
    found = tasks.cluster(dom(spark, sf), S)
    return found.labels


@register("i8_regression_task")
def i8(spark, sf):
    return tasks.regress(prepared(spark, sf), S, n_estimators=5)


@register("i9_clustering_task")
def i9(spark, sf):
    return tasks.cluster(prepared(spark, sf), S).centroids


# --- evaluation and experiments --------------------------------------------
@register("j15_holdout")
def j15(spark, sf):
    """The whole report of a hold-out; tests count it anew from the predictions."""
    return _holdout(spark, sf, "DecisionTree").report


@register("j16_cross_validation")
def j16(spark, sf):
    return evaluate.score_board(prepared(spark, sf), S, [evaluate.build_pipeline("robust", "onehot", SMALL["DecisionTree"], model="DecisionTree")], 3, parallelism=3)


@register("k3_outlier_ablation")
def k3(spark, sf):
    return ablations.ablation_outlier(panel(spark, sf), S, cv=2, models=TREE, parallelism=2)


@register("k4_imbalance_ablation")
def k4(spark, sf):
    """The imbalance stage of the run as it is by default: its models with their starting parameters, all its folds."""
    whole = run.RunOptions()
    return ablations.ablation_imbalance(prepared(spark, sf), S, whole.ablation_models, whole.cv_folds, parallelism=4)


@register("k5_scaler_encoder_ablation")
def k5(spark, sf):
    return ablations.ablation_preprocessing(prepared(spark, sf), S, SMALL["DecisionTree"], cv=2, parallelism=4)


@register("k6_model_comparison")
def k6(spark, sf):
    return ablations.compare_models(prepared(spark, sf), S, 2, {n: SMALL[n] for n in ("DecisionTree", "RandomForest", "LogisticRegression")}, parallelism=2)


SWEEP = {
    "scalers": ["standard", "robust"], "encoders": ["ordinal", "target"], "models": ["DecisionTree"], "cv": 2, "parallelism": 4, "strict": True,
    "param_grids": {"DecisionTree": {"max_depth": [3, 5]}},
}


@register("k7_full_sweep")
def k7(spark, sf):
    return sweep.run_full_sweep(prepared(spark, sf), S, **SWEEP)[0]


@register("k9_elbow")
def k9(spark, sf):
    return tasks.kmeans_elbow(prepared(spark, sf), S)


@register("f13_elbow_curve")
def f13(spark, sf):
    return tasks.kmeans_elbow(dom(spark, sf), S).orderBy("k")


@register("k10_grid_search")
def k10(spark, sf):
    config = evaluate.build_pipeline("robust", "ordinal", SMALL["DecisionTree"])
    return evaluate.tune_with_gridsearch(prepared(spark, sf), S, config, {"max_depth": [3, 5], "min_samples_leaf": [1, 20]}, 2, parallelism=2)[0]


@register("k11_param_grids")
def k11(spark, sf):
    """The whole tree grid of the search by name, each combination cross-validated."""
    grid = {"DecisionTree": search.get_param_grid_for("DecisionTree")}
    options = {"scalers": ["robust"], "encoders": ["ordinal"], "models": ["DecisionTree"], "param_grids": grid, "cv": 2, "parallelism": 4, "strict": True}
    return sweep.run_full_sweep(prepared(spark, sf), S, **options)[0].drop("fit_seconds")


@register("k12_model_factory")
def k12(spark, sf):
    """The factory's tree with its starting parameters on one hold-out."""
    config = evaluate.build_pipeline("robust", "ordinal", models.get_models("balanced")["DecisionTree"])
    return evaluate.evaluate_holdout(prepared(spark, sf), S, config).summary


@register("k13_pipeline_with_smote")
def k13(spark, sf):
    config = evaluate.build_pipeline("standard", "ordinal", models.ModelSpec("DecisionTree", {"max_depth": 5}), use_smote=True)
    return evaluate.evaluate_holdout(prepared(spark, sf), S, config).summary


@register("k14_sweep_artifacts")
def k14(spark, sf):
    options = {**SWEEP, "scalers": ["robust"], "encoders": ["ordinal"]}
    board, top, _ = sweep.run_full_sweep(prepared(spark, sf), S, **options)
    written = sinks.save_sweep_artifacts(board, top, board.where("rank = 1"), fresh_path(spark, "sweep"))
    return spark.read.option("header", True).csv(written["leaderboard"]).drop("fit_seconds")


REPORTS = [
    "aux_kmeans_centroids", "aux_kmeans_elbow", "aux_kmeans_sizes", "aux_kmeans_summary", "aux_regression", "categorical_distributions",
    "confusion_matrix", "correlation_matrix", "cv_baseline", "dirty_values", "final_pipeline", "final_summary", "missing_report",
    "numeric_describe_clean", "numeric_describe_raw", "outlier_summary", "per_class", "target_distribution",
]


@register("k15_staged_run", "SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in REPORTS) + ") AS r(report)")
def k15(spark, sf):
    options = run.RunOptions(
        stages=("eda", "auxiliary"), cv_folds=2, skip_grid=True, models=TREE, save_pipeline=True,
        cluster_options={"restarts": 1}, regression_options={"n_estimators": 3},
    )
    result = run.run(panel(spark, sf), S, fresh_path(spark, "run"), options)
    return spark.createDataFrame(sorted((n,) for n in result.written), "report string")
