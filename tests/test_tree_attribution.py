"""Tree attributions against all coalitions, and against the model-free explainer."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import attribution, candidates, splits, tree_attribution
from claimloom.operators.candidates import Sizes, as_pipeline
from claimloom.plans import training

SMALL = Sizes(tree_leaf=2, tree_depth=5, forest_trees=4, forest_depth=4, forest_leaf=2, rounds=4, round_depth=3)


@pytest.fixture(scope="module")
def folds(modeling):
    train, test = training.split(modeling)
    return train.cache(), test.limit(20).cache()


def by_row(frame, columns):
    return sorted((tuple(r[c] for c in columns), np.array(r.shap), np.array(r.base)) for r in frame.collect())


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "random_forest_regressor", "boosted_regressor"])
def test_equals_coalitions_on_seven_features(folds, name):
    train, test = folds
    regressors = candidates.fitting_regressors(train, SMALL)
    model = regressors[name] if name in regressors else candidates.classifiers(SMALL)[name]
    classes = 1 if name in regressors else 5
    fitted = as_pipeline(model).fit(train)
    background = splits.sample_rows(train, [F.col(c).cast("string") for c in S.FEATURES], 7)
    keys = ["BENE_ID", *S.FEATURES]
    a = by_row(attribution.shapley(fitted, test, background, classes), keys)
    b = by_row(attribution.explained(fitted, test, background, classes), keys)
    assert len(a) == len(b) == 20
    for (k, x, m), (l, y, n) in zip(a, b):
        assert k == l and np.allclose(x, y, atol=1e-9) and np.allclose(m, n, atol=1e-9)


def random_tree(draw, n_features, depth):
    """Nodes as tuples, with covers that add up; node 0 is the root."""
    nodes = []

    def grow(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == depth or draw.random() < 0.15:
            nodes[at] = (0, at, -1, -1, -1, None, cover, [float(draw.normal()), float(draw.normal())])
            return at
        part = draw.uniform(0.1, 0.9)
        split = int(draw.integers(n_features)), float(draw.uniform(-1, 1))
        left, right = grow(level + 1, cover * part), grow(level + 1, cover * (1 - part))
        nodes[at] = (0, at, left, right, *split, cover, [0.0, 0.0])
        return at

    grow(0, 100.0)
    return nodes


def expected(nodes, x, known):
    """Output of the tree when only some features are known."""
    def go(at):
        _, _, left, right, feature, threshold, cover, values = nodes[at]
        if left < 0:
            return np.array(values)
        if feature in known:
            return go(left if x[feature] <= threshold else right)
        return (nodes[left][6] * go(left) + nodes[right][6] * go(right)) / cover

    return go(0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cover_form_equals_all_subsets(spark, monkeypatch, seed):
    monkeypatch.setattr(tree_attribution, "SLICE_LEAVES", 5)
    monkeypatch.setattr(tree_attribution, "LEAF_BLOCK", 3)
    draw, n = np.random.default_rng(seed), 5
    nodes = random_tree(draw, n, 6)
    rows = [[float(v) for v in draw.uniform(-1, 1, n)] for _ in range(4)]
    frame = spark.createDataFrame([(r,) for r in rows], "__x array<double>")
    found = tree_attribution.tree_values(spark.createDataFrame(nodes, tree_attribution.NODES), frame, n, 2)
    got = {tuple(r["__x"]): (np.array(r.shap), np.array(r.base)) for r in found.collect()}
    for x in rows:
        shap, base = got[tuple(x)]
        assert np.allclose(base, expected(nodes, x, set()))
        for i in range(n):
            others = [j for j in range(n) if j != i]
            want = sum(
                factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n)
                * (expected(nodes, x, {*s, i}) - expected(nodes, x, set(s)))
                for k in range(n) for s in combinations(others, k)
            )
            assert np.allclose(shap[i], want, atol=1e-9)


@pytest.mark.parametrize("kind,settings", [
    (RandomForestRegressor, {"numTrees": 5, "maxDepth": 10, "featureSubsetStrategy": "all"}),
    (GBTRegressor, {"maxIter": 4, "maxDepth": 6}),
])
def test_forty_features_add_up(spark, kind, settings):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(400, 40))
    y = x[:, :20].sum(axis=1) + x[:, 3] * x[:, 30]
    names = [f"f{i}" for i in range(40)]
    frame = spark.createDataFrame([[*map(float, r), float(v)] for r, v in zip(x, y)], [*names, "y"])
    encoded = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
    fitted = kind(labelCol="y", seed=1, **settings).fit(encoded)
    rows = encoded.limit(30).select(vector_to_array("features").alias("__x"), "features").cache()
    background = [(r.tolist(), 0.1) for r in x[100:110]]
    nodes = tree_attribution.model_nodes(fitted, 1).cache()
    predicted = {tuple(r["__x"]): r.prediction for r in fitted.transform(rows).collect()}
    for sample in (None, background):
        for r in tree_attribution.tree_values(nodes, rows.select("__x"), 40, 1, sample).collect():
            assert np.isclose(np.sum(r.shap) + r.base[0], predicted[tuple(r["__x"])], atol=1e-9)
            assert len(r.shap) == 40


def test_empty_rows_and_missing_numbers(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0, 0.5, 4.0, [0.0]), (0, 1, -1, -1, -1, None, 1.0, [1.0]), (0, 2, -1, -1, -1, None, 3.0, [5.0])],
        tree_attribution.NODES,
    )
    rows = spark.createDataFrame([([float("nan")],), ([0.5],)], "__x array<double>")
    got = sorted(r.shap[0][0] for r in tree_attribution.tree_values(nodes, rows, 1, 1).collect())
    assert got == [-3.0, 1.0]
    assert tree_attribution.tree_values(nodes, rows.limit(0), 1, 1).collect() == []
