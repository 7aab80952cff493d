"""Multi-class boosting against a plain version, and its behaviour over rounds and restarts."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from claimloom.operators import boosting
from claimloom.operators.boosting import Settings
from claimloom.operators.candidates import BoostedClassifier, BoostedModel, BoostedRegressor
from claimloom.operators.tree_attribution import model_nodes


def table(spark, n=600, seed=3, classes=3):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(n, 4)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 + draw.normal(0, 0.2, n) > 0.7).astype(int) + (x[:, 2] > 0.5) * (classes > 2)
    w = np.where(y == 0, 0.5, 1.5)
    rows = [(Vectors.dense(v), float(c), float(k)) for v, c, k in zip(x, y, w)]
    return spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(3).cache(), x, y, w


def plain_round(x, y, w, scores, settings):
    """One round with all rows and features: exact greedy trees over all cuts between different values."""
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    out = np.zeros_like(scores)
    for c in range(settings.classes):
        g, h = w * (p[:, c] - (y == c)), w * np.maximum(p[:, c] * (1 - p[:, c]), 1e-16)

        def grow(rows, level, c=c, g=g, h=h):
            best, gs, hs = (1e-12, None, None), g[rows].sum(), h[rows].sum()
            for i in range(x.shape[1] if level < settings.depth else 0):
                for cut in np.unique(x[:, i])[:-1]:
                    left = rows[x[rows, i] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    if min(hl, hs - hl) < settings.least_weight:
                        continue
                    gain = (gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)) / 2
                    if gain > best[0] + 1e-12:
                        best = (gain, i, cut)
            if best[1] is None:
                out[rows, c] = -settings.rate * gs / (hs + 1)
                return
            side = x[rows, best[1]] <= best[2]
            grow(rows[side], level + 1)
            grow(rows[~side], level + 1)

        grow(np.arange(len(x)), 0)
    return scores + out


def log_loss(scores, y, w):
    top = scores.max(axis=1, keepdims=True)
    return (w * (top[:, 0] + np.log(np.exp(scores - top).sum(axis=1)) - scores[np.arange(len(y)), y])).sum() / len(y)


def staged(ensemble, x):
    return [boosting.Ensemble(ensemble.rounds[:k], ensemble.edges).margins(x) for k in range(1, len(ensemble.rounds) + 1)]


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_BLOCK", 100)
    monkeypatch.setattr(boosting, "NODES_PER_KEY", 2)
    frame, x, y, w = table(spark, 300)
    settings = Settings(3, rounds=6, depth=3, rate=0.3, row_share=1.0, feature_share=1.0)
    ensemble = boosting.fit(frame, "features", "label", "weight", settings)
    scores = np.zeros((len(x), 3))
    for got in staged(ensemble, x):
        scores = plain_round(x, y, w, scores, settings)
        assert np.allclose(got, scores, atol=1e-9)
    assert ensemble.losses == pytest.approx([log_loss(staged(ensemble, x)[3], y, w)])


def test_loss_falls_each_round(spark):
    frame, x, y, w = table(spark)
    ensemble = boosting.fit(frame, "features", "label", "weight", Settings(3, rounds=12, depth=4))
    losses = [log_loss(np.zeros((len(x), 3)), y, w), *(log_loss(s, y, w) for s in staged(ensemble, x))]
    assert all(b < a for a, b in zip(losses, losses[1:])) and len(losses) == 13
    assert ensemble.importances().argmin() == 3 and ensemble.importances().sum() == pytest.approx(1)


def test_goes_on_after_a_stop(spark, monkeypatch, tmp_path):
    """The same trees as without a stop; only rounds that were not stored are fitted again."""
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 4)
    frame, x, _, _ = table(spark)
    settings, store = Settings(3, rounds=10, depth=3), str(tmp_path / "state")
    whole = boosting.fit(frame, "features", "label", "weight", settings)
    grown, real = [], boosting._round

    def stopping(state, pending, starts, given, number):
        grown.append(number)
        if number == 7 and grown.count(7) == 1:
            raise RuntimeError("stopped")
        return real(state, pending, starts, given, number)

    monkeypatch.setattr(boosting, "_round", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        boosting.fit(frame, "features", "label", "weight", settings, store)
    resumed = boosting.fit(frame, "features", "label", "weight", settings, store)
    assert grown == [0, 1, 2, 3, 4, 5, 6, 7, 4, 5, 6, 7, 8, 9]
    assert np.allclose(resumed.margins(x), whole.margins(x), atol=1e-9)
    boosting.fit(frame, "features", "label", "weight", settings, store)
    assert len(grown) == 14
    # Other settings find nothing.
    boosting.fit(frame, "features", "label", "weight", Settings(3, rounds=1, depth=2), store)
    assert len(grown) == 15


def test_many_different_values_and_two_classes(spark):
    frame, x, y, _ = table(spark, classes=2)
    ensemble = boosting.fit(frame, "features", "label", None, Settings(2, rounds=8, depth=4, max_bins=8))
    assert max(map(len, ensemble.edges)) <= 7
    assert (ensemble.margins(x).argmax(axis=1) == y).mean() > 0.85


def test_saved_model_scores_the_same(spark, tmp_path):
    frame, x, _, _ = table(spark)
    model = BoostedClassifier(numClasses=3, maxIter=3, maxDepth=3, weightCol="weight").fit(frame)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(again.stages[0], BoostedModel)
    a, b = ([r.probability.toArray() for r in m.transform(frame).collect()] for m in (model, again))
    assert np.allclose(a, b) and np.allclose(np.sum(a, axis=1), 1)
    assert model.transform(frame.limit(0)).collect() == []


def test_no_rows(spark):
    frame, *_ = table(spark, 5)
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(frame.limit(0), "features", "label", None, Settings(3))


def numbers(spark, n=500, seed=4):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(n, 4)), 1)
    y = 11 + x[:, 0] ** 2 + 2 * (x[:, 1] > 0.3) * x[:, 2] + draw.normal(0, 0.1, n)
    return spark.createDataFrame([(Vectors.dense(v), float(k)) for v, k in zip(x, y)], ["features", "y"]).repartition(3).cache(), x, y


def test_number_equals_mllib(spark):
    """With all rows and features the trees, their importances and the attributed nodes are MLlib's."""
    # Nodes with few rows have several splits of the same gain.
    frame, _, _ = numbers(spark, 3000)
    given = {"labelCol": "y", "maxIter": 6, "maxDepth": 2, "maxBins": 256}
    theirs, ours = GBTRegressor(**given).fit(frame), BoostedRegressor(**given).fit(frame)
    a, b = ([r.prediction for r in m.transform(frame).orderBy("features").collect()] for m in (theirs, ours))
    assert np.allclose(a, b, atol=1e-9)
    assert np.allclose(theirs.featureImportances.toArray(), ours.featureImportances, atol=1e-9)
    for wanted, got in zip(*(
        sorted((r.tree, r.cover, r["values"][0]) for r in model_nodes(m, 1).filter("left < 0").collect()) for m in (theirs, ours)
    )):
        assert wanted == pytest.approx(got)


def test_number_with_samples_and_after_saving(spark, tmp_path):
    frame, x, y = numbers(spark)
    model = BoostedRegressor(
        labelCol="y", maxIter=30, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.7"
    ).fit(frame)
    errors = [((staged_scores[:, 0] - y) ** 2).mean() for staged_scores in staged(model.ensemble, x)]
    assert errors[-1] < 0.05 * y.var() and model.ensemble.losses == pytest.approx(errors[3::4][:7])
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = ([r.prediction for r in m.transform(frame).collect()] for m in (model, again))
    assert a == b and model.transform(frame.limit(0)).collect() == []


def test_lighter_children_are_summed_and_scores_folded_each_round(spark, monkeypatch):
    """A level sums at most half of the curvature of the rows, and tasks apply the trees of a round once."""
    sent, applied = [], []
    advanced = boosting._advanced

    def watched(state, rounds):
        applied.append(len(rounds))
        return advanced(state, rounds)

    def added(sums, parts, keys, real=boosting._added):
        found = real(sums, parts, keys)
        sent.append(sum(float(total[1].sum()) for total in found.values()))
        return found

    monkeypatch.setattr(boosting, "_advanced", watched)
    monkeypatch.setattr(boosting, "_added", added)
    frame, *_ = table(spark)
    boosting.fit(frame, "features", "label", "weight", Settings(3, rounds=2, depth=3, row_share=1.0))
    assert applied == [0, 1]
    assert len(sent) == 6 and all(max(sent[k + 1 : k + 3]) <= 0.5 * sent[k] + 1e-9 for k in (0, 3))
