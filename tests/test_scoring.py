"""Scores of one's own in cross-validation, sweep and grid search, and failures that stay in their row."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import prep
from panelkit.plans import ablations, evaluate, models, sweep
from panelkit.session import fresh_path
from panelkit.spec import PanelSpec

SPEC = PanelSpec(entity="who", order=("row_id",), row_id="row_id", label="label")
TREE = models.ModelSpec("DecisionTree", {"max_depth": 3})


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, f"w{i % 9}", "ab"[i % 2] if i % 7 else "c", float(i % 2) + (i % 5) / 10, f"v{i % 3}") for i in range(240)]
    return spark.createDataFrame(made, "row_id long, who string, label string, a double, city string").drop("who")


def wrong(counts, by):
    total = F.sum("n")
    return counts.groupBy(*by).agg((F.sum(F.when(F.col("actual") != F.col("predicted"), F.col("n")).otherwise(0)) / total).alias("value"))


def test_scoring(rows):
    config = evaluate.build_pipeline("robust", "onehot", TREE, model="tree")
    board = evaluate.score_board(rows, SPEC, [config], 2, scoring={"wrong": wrong}).first()
    assert board["wrong"] == pytest.approx(1 - board["accuracy"])
    options = {"scalers": ["standard"], "encoders": ["ordinal"], "models": ["DecisionTree"], "param_grids": {"DecisionTree": {"max_depth": [1, 3]}}, "cv": 2}
    ranked, _, best = sweep.run_full_sweep(rows, SPEC, primary_metric="wrong", scoring={"wrong": wrong}, **options)
    assert ranked.count() == 2 and best["wrong"] == max(r["wrong"] for r in ranked.collect())
    _, chosen, value, _ = evaluate.tune_with_gridsearch(rows, SPEC, config, {"max_depth": [1, 3]}, 2, "wrong", scoring={"wrong": wrong})
    assert chosen["max_depth"] in (1, 3) and 0 <= value <= 1
    with pytest.raises(ValueError, match="primary_metric"):
        sweep.run_full_sweep(rows, SPEC, primary_metric="other", **options)


def test_a_failing_preparation_keeps_its_row(rows, monkeypatch):
    plain = prep.FittedPrep.vectors

    def vectors(self, *args, **kwargs):
        if self.encoder == "ordinal":
            raise ValueError("no ordinal here")
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(prep.FittedPrep, "vectors", vectors)
    board = ablations.ablation_preprocessing(rows, SPEC, TREE, cv=2).collect()
    assert len(board) == 9
    for r in board:
        assert (r["error"] == "no ordinal here" and r["macro_f1"] is None) if r["encoder"] == "ordinal" else (r["error"] is None and r["macro_f1"] is not None)


def test_a_failure_is_no_result(rows, monkeypatch):
    """A job that ends or a lost executor ends the sweep; a refused configuration is left out or, if asked, an error."""
    fit = evaluate.fit_config
    options = {"scalers": ["robust"], "encoders": ["ordinal"], "models": ["DecisionTree"], "cv": 2}
    grid = {"param_grids": {"DecisionTree": {"max_depth": [1, 3]}}}

    def lost(config, train, *args):
        if config.model.params["max_depth"] == 3:
            train.foreach(lambda row: 1 / 0)
        return fit(config, train, *args)

    monkeypatch.setattr(evaluate, "fit_config", lost)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        sweep.run_full_sweep(rows, SPEC, **options, **grid)
    monkeypatch.setattr(evaluate, "fit_config", fit)
    refused = {"param_grids": {"DecisionTree": {"max_depth": [1, -1]}}}
    assert sweep.run_full_sweep(rows, SPEC, **options, **refused)[0].count() == 1
    with pytest.raises(ValueError, match="1 of 2 configurations"):
        sweep.run_full_sweep(rows, SPEC, strict=True, **options, **refused)
    broken = {"tree": models.ModelSpec("DecisionTree", {"max_depth": -1}), "fits": TREE}
    for compare in (ablations.ablation_imbalance, ablations.compare_models):
        with pytest.raises(ValueError, match="have no scores"):
            compare(rows, SPEC, cv=2, models=broken)


def test_an_ended_sweep_goes_on_where_it_was(rows, spark, monkeypatch):
    """Finished (configuration, fold) pairs are read from the ledger; the board is that of an undisturbed run."""
    options = {"scalers": ["standard", "robust"], "encoders": ["ordinal"], "models": ["DecisionTree"], "param_grids": {"DecisionTree": {"max_depth": [1, 3]}}, "cv": 2}
    plain = sweep.run_full_sweep(rows, SPEC, **options)[0].drop("fit_seconds").orderBy("rank").collect()
    ledger, fits, fit = fresh_path(spark, "ledger"), [], evaluate.fit_config

    # what a run that was ended had finished: one depth for both scalers
    sweep.run_full_sweep(rows, SPEC, ledger=ledger, **{**options, "param_grids": {"DecisionTree": {"max_depth": [3]}}})
    fits.clear()
    monkeypatch.setattr(evaluate, "fit_config", lambda *a: fits.append(a[0]) or fit(*a))
    again = sweep.run_full_sweep(rows, SPEC, ledger=ledger, **options)[0].drop("fit_seconds").orderBy("rank").collect()
    assert again == plain and len(fits) == 4
    fits.clear()
    assert sweep.run_full_sweep(rows, SPEC, ledger=ledger, **options)[0].drop("fit_seconds").orderBy("rank").collect() == plain
    assert not fits


def test_depths_of_one_tree_share_a_fit(rows, monkeypatch):
    """A tree does not depend on the levels below: the deepest gives the others, which score as if fitted alone."""
    fits, fit = [], evaluate.fit_config
    monkeypatch.setattr(evaluate, "fit_config", lambda *a: fits.append(a[0].model.params) or fit(*a))
    configs = [
        evaluate.build_pipeline("robust", "ordinal", models.ModelSpec("DecisionTree", {"max_depth": d, "min_samples_leaf": n}), name=f"{d} {n}")
        for n in (1, 9) for d in (1, None, 3, 31)
    ]
    scores = lambda b: {r["name"]: (r["macro_f1"], r["accuracy"], r["error"]) for r in b.collect()}
    together = scores(evaluate.score_board(rows, SPEC, configs, 2))
    assert sorted((f["max_depth"] or 99, f["min_samples_leaf"]) for f in fits) == [(31, 1)] + [(31, 9)] + [(99, 1)] * 2 + [(99, 9)] * 2
    assert together["31 1"][0] is None and "31" in together["31 1"][2]
    for config in configs:
        assert scores(evaluate.score_board(rows, SPEC, [config], 2)) == {config.tags["name"]: together[config.tags["name"]]}


def test_holdout_report_counts_its_predictions(rows):
    held = evaluate.evaluate_holdout(rows, SPEC, evaluate.build_pipeline("robust", "onehot", TREE))
    pairs = [(r["label"], r["predicted"]) for r in held.predictions.collect()]
    told = {(r["class"], r["metric"]): r["value"] for r in held.report.collect()}
    for own in "abc":
        hit = sum(a == own == p for a, p in pairs)
        actual, said = sum(a == own for a, _ in pairs), sum(p == own for _, p in pairs)
        assert told[own, "support"] == actual
        assert told[own, "recall"] == pytest.approx(hit / actual if actual else 0)
        assert told[own, "precision"] == pytest.approx(hit / said if said else 0)
