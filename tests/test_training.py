"""Training run, saved models, scoring and attribution on the small table."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import attribution, candidates, scoring, splits, tuning
from claimloom.operators.candidates import Sizes, as_pipeline
from claimloom.plans import training
from claimloom.sources import bundles, runs

TINY = Sizes(tree_leaf=2, tree_depth=3, forest_trees=3, forest_depth=3, forest_leaf=2, rounds=2, round_depth=2)
SPACES = {"random_forest": {"numTrees": [2, 3], "maxDepth": [2, 3]}}


@pytest.fixture(scope="module")
def exported(spark, claims, income, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("export"))
    training.run(spark, claims, income, path, TINY, SPACES, n_iter=2)
    return path


@pytest.fixture(scope="module")
def bundle(spark, exported):
    return bundles.load_bundle(spark, exported)


@pytest.fixture(scope="module")
def folds(modeling):
    train, test = training.split(modeling)
    return train.cache(), test.cache()


def valid_claim(spark):
    return spark.createDataFrame([("D110", "H100", "U", 5, 2, 71300.25)], S.FEATURE_SCHEMA)


def test_candidate_names(spark):
    assert list(candidates.classifiers()) == ["knn", "decision_tree", "random_forest", "boosted_trees"]
    assert list(candidates.regressors(10)) == [
        "linear_regression", "ridge_regression", "random_forest_regressor", "boosted_regressor",
    ]


def test_drawn_settings_are_different_and_repeatable():
    space = tuning.SEARCH_SPACES["boosted_trees"]
    drawn = tuning.draw_settings(space, 10)
    assert len({str(s) for s in drawn}) == 10 and drawn == tuning.draw_settings(space, 10)
    assert all(s[k] in space[k] for s in drawn for k in space)
    assert len(tuning.draw_settings({"a": [1, 2]}, 10)) == 2


def test_exported_metadata(spark, exported, claims):
    winners = {r.task: r for r in bundles.load_table(spark, exported, "winners").collect()}
    metrics = bundles.load_table(spark, exported, "metrics").collect()
    best = {
        task: max if task == "tier" else min for task in winners
    }
    for task, name in (("tier", "selection_score"), ("charge", "rmse_log")):
        values = {r.model: r.value for r in metrics if r.task == task and r.metric == name}
        assert len(values) == 4
        assert values[winners[task].model] == best[task](values.values())
    folds = {r.fold: r for r in bundles.load_table(spark, exported, "folds").collect()}
    assert folds["train"].rows + folds["test"].rows == claims.count()
    assert bundles.model_info(spark, exported).count() == sum(
        r.model == winners[r.task].model for r in metrics
    )
    log = runs.read_runs(spark, f"{exported}/runs")
    assert log.select("task", "model").distinct().count() == 9


def test_results_of_every_candidate_are_kept(spark, exported):
    confusion = bundles.load_table(spark, exported, "confusion")
    rows = bundles.load_table(spark, exported, "folds").filter("fold = 'test'").first().rows
    assert confusion.count() == 4 * len(S.TIERS)
    for model, total in confusion.groupBy("model").agg(
        sum(F.sum(f"pred_{t}") for t in S.TIERS).alias("n")
    ).collect():
        assert model in candidates.classifiers() and total == rows
    importance = bundles.load_table(spark, exported, "importance").groupBy("model").agg(F.sum("importance").alias("all"))
    shares = {r.model: round(r["all"], 6) for r in importance.collect()}
    # The mean over classes; a class whose trees never split has no importances.
    assert 0 < shares.pop("boosted_trees") <= 1
    assert shares == dict.fromkeys(("decision_tree", "random_forest", "random_forest_regressor", "boosted_regressor"), 1.0)
    log = runs.read_runs(spark, f"{exported}/runs").filter("kind = 'param' AND model = 'decision_tree'")
    assert {r.key: r.value for r in log.collect()}["maxDepth"] == str(TINY.tree_depth)


def test_missing_export_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No exported model"):
        bundles.load_bundle(spark, str(tmp_path))


def test_background_sample(bundle):
    assert bundle.background.columns == S.FEATURES
    assert 0 < bundle.background.count() <= S.BACKGROUND_ROWS


def test_tier_prediction_is_well_formed(spark, bundle):
    small = scoring.Bundle(bundle.classifier, bundle.regressor, bundle.metadata, bundle.background.limit(5))
    odd = valid_claim(spark).withColumn(S.CODE_COLUMNS[0], F.lit("ZZZ999"))
    rows = scoring.predict_tier(small, valid_claim(spark).unionByName(odd)).collect()
    assert len(rows) == 2
    for row in rows:
        assert row.tier in S.TIERS and row.tier_description == S.TIER_DESCRIPTIONS[row.tier]
        assert sum(row.probabilities.values()) == pytest.approx(1.0, abs=1e-6)
        assert row.confidence == pytest.approx(row.probabilities[str(row.tier)])
        sizes = [abs(c.contribution) for c in row.top_contributions]
        assert len(sizes) == S.TOP_FEATURES and sizes == sorted(sizes, reverse=True)
        assert all((c.contribution > 0) == (c.direction == "increases") for c in row.top_contributions)
        assert row.model_name == bundle.classifier_name


def test_all_background_rows_count(folds, bundle, monkeypatch):
    train, _ = folds
    one = train.select(*S.FEATURES).limit(1)
    many = one
    for _ in range(8):
        many = many.unionByName(many)
    other = train.select(*S.FEATURES).orderBy(F.desc(S.INCOME)).limit(1)
    shares = attribution.background_vectors(bundle.classifier, many.unionByName(other))
    assert sorted(round(s, 6) for _, s in shares) == [round(1 / 257, 6), round(256 / 257, 6)]
    monkeypatch.setattr(attribution, "MAX_BACKGROUND", 1)
    with pytest.raises(ValueError, match="draw a sample"):
        attribution.background_vectors(bundle.classifier, many.unionByName(other))


def test_bins_keep_code_frequencies_apart():
    trees = [m for m in candidates.classifiers().values() if m.hasParam("maxBins")]
    assert len(trees) == 3 and all(m.getOrDefault("maxBins") == 256 for m in trees)


def test_without_background_contributions_are_empty(spark, bundle):
    bare = scoring.Bundle(bundle.classifier, bundle.regressor, bundle.metadata, None)
    row = scoring.predict_tier(bare, valid_claim(spark)).first()
    assert row.top_contributions == [] and row.tier in S.TIERS


def test_charge_is_positive(spark, bundle):
    row = scoring.predict_charge(bundle, valid_claim(spark)).first()
    assert row.predicted_charge == pytest.approx(np.exp(row.predicted_log_charge)) and row.predicted_charge > 0


@pytest.mark.parametrize("name", ["decision_tree", "boosted_trees"])
def test_saved_models_score_the_same(folds, name, tmp_path):
    train, test = folds
    fitted = as_pipeline(candidates.classifiers(TINY)[name]).fit(train)
    fitted.write().overwrite().save(str(tmp_path / name))
    fitted.write().overwrite().save(str(tmp_path / name))
    loaded = PipelineModel.load(str(tmp_path / name))
    pick = ["BENE_ID", *S.FEATURES, "probability", "prediction"]
    a, b = (sorted(map(str, m.transform(test).select(*pick).collect())) for m in (fitted, loaded))
    assert a == b
    importances = candidates.feature_importance(loaded).collect()
    assert len(importances) == 7
    assert [r.importance for r in importances] == sorted((r.importance for r in importances), reverse=True)


def test_linear_models_have_no_importances(folds):
    train, _ = folds
    model = as_pipeline(candidates.fitting_regressors(train, TINY)["linear_regression"]).fit(train)
    assert candidates.feature_importance(model) is None


def test_ridge_equals_closed_form(folds):
    train, _ = folds
    model = as_pipeline(candidates.fitting_regressors(train, TINY)["ridge_regression"]).fit(train)
    rows = model.transform(train).select("features", S.LOG_TOTAL, "prediction").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r[S.LOG_TOTAL] for r in rows])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose([r.prediction for r in rows], xc @ w + y.mean(), atol=1e-6)


@pytest.mark.parametrize("name", ["decision_tree", "random_forest"])
def test_shapley_values_add_up(folds, name):
    train, test = folds
    fitted = as_pipeline(candidates.classifiers(TINY)[name]).fit(train)
    background = splits.sample_rows(train, [F.col(c).cast("string") for c in S.FEATURES], 6)
    rows = attribution.shapley(fitted, test.limit(12).cache(), background, 5)
    explained = fitted.transform(rows).collect()
    assert len(explained) == 12
    for row in explained:
        p = np.zeros(5)
        p[: len(row.probability)] = row.probability.toArray()
        total = np.array(row.shap).sum(axis=0) + np.array(row.base)
        assert np.allclose(total, p, atol=1e-9)


def test_shapley_of_linear_model_equals_closed_form(folds):
    train, test = folds
    fitted = as_pipeline(candidates.fitting_regressors(train, TINY)["ridge_regression"]).fit(train)
    background = train.limit(9).cache()
    some = test.limit(5).cache()
    exact = attribution.shapley(fitted, some, background, 1).select("BENE_ID", *S.FEATURES, "shap").collect()
    closed = attribution.linear_values(fitted, some, background).select("BENE_ID", *S.FEATURES, "shap").collect()
    for a, b in zip(sorted(exact, key=str), sorted(closed, key=str)):
        assert np.allclose(a["shap"], b["shap"], atol=1e-9)


def test_explainer_needs_a_background(folds):
    train, test = folds
    fitted = as_pipeline(candidates.classifiers(TINY)["decision_tree"]).fit(train)
    with pytest.raises(ValueError, match="background"):
        attribution.shapley(fitted, test, None, 5)


def test_tuning_keeps_people_together_and_ranks_settings(folds):
    train, _ = folds
    found = tuning.tune_classifier("boosted_trees", train, 2, 2, {"maxIter": [1, 2]}, TINY)
    assert found.score == max(t["score"] for t in found.tried) and len(found.tried) == 2
    assert found.settings in [t["settings"] for t in found.tried]


def test_a_stopped_search_goes_on(folds, monkeypatch, tmp_path):
    train, _ = folds
    fits, real = [], tuning._with

    def counting(model, setting):
        fits.append(setting)
        if len(fits) == 4:
            raise RuntimeError("stopped")
        return real(model, setting)

    def search(n=3):
        space = {"numTrees": [1, 2, 3, 4]}
        return tuning.tune_classifier("random_forest", train, n, 2, space, TINY, parallelism=1, store=str(tmp_path / "trials"))

    monkeypatch.setattr(tuning, "_with", counting)
    with pytest.raises(RuntimeError, match="stopped"):
        search()
    found = search()
    # Three trials before the stop, the one that it hit, and the three that were missing.
    assert len(fits) == 7 and len(found.tried) == 3
    assert search() == found and len(fits) == 7
    rows = train.sparkSession.read.parquet(str(tmp_path / "trials")).collect()
    assert len(rows) == 6 and {r.fold for r in rows} == {0, 1} and all(r.seconds > 0 for r in rows)


def test_drift_job_from_files(spark, claims, income, exported, bundle, tmp_path):
    from claimloom.__main__ import main
    from claimloom.plans import monitoring

    claims.write.parquet(str(tmp_path / "claims.parquet"))
    income.write.parquet(str(tmp_path / "income.parquet"))
    shared = ["--claims", str(tmp_path / "claims.parquet"), "--income", str(tmp_path / "income.parquet"),
              "--models", exported]
    main(["drift", *shared, "--output", str(tmp_path / "drift")])
    for part, columns in (("features", len(S.FEATURES)), ("predictions", 1)):
        summary = spark.read.parquet(str(tmp_path / "drift" / part / "summary")).first()
        assert summary["columns"] == columns and 0 <= summary.drifted_share <= 1
    shifted = claims.withColumn("Median_Income", F.lit(1_000_000.0))
    shifted.write.csv(str(tmp_path / "batch.csv"), header=True)
    main(["drift", *shared, "--output", str(tmp_path / "moved"), "--current", str(tmp_path / "batch.csv")])
    scores = spark.read.parquet(str(tmp_path / "moved" / "features" / "column_scores"))
    assert {r.column_name: r.drifted for r in scores.collect()}["Median_Income"]
    assert monitoring.PREDICTION == "predicted_tier"


def test_score_job_from_files(spark, claims, exported, tmp_path):
    from claimloom.__main__ import main

    rows = claims.limit(6).withColumn("Median_Income", F.lit(52000.5)).withColumn(
        S.FLAG_COLUMN, F.when(F.col("BENE_ID") == claims.first().BENE_ID, "X").otherwise(F.col(S.FLAG_COLUMN))
    )
    rows.write.parquet(str(tmp_path / "in.parquet"))
    main(["score", "--requests", str(tmp_path / "in.parquet"), "--models", exported,
          "--output", str(tmp_path / "out"), "--no-explanations"])
    good, bad = (spark.read.parquet(str(tmp_path / "out" / p)) for p in ("scores", "rejected"))
    assert good.count() + bad.count() == 6 and bad.count() >= 1
    assert good.filter("predicted_charge > 0 AND tier BETWEEN 1 AND 5").count() == good.count()
