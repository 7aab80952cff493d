"""What keeps work in proportion to the input."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.operators import forest, knn, tree_attribution
from claimloom.plans.views import Tables

SMALL = "/root/testdata/sf0.001"


def test_claim_types_are_filtered_before_the_joins(spark):
    t = Tables(spark, SMALL)
    for number, side in ((1, t.raw_inpatient()), (0, t.raw_outpatient())):
        whole = t.raw().filter(f"PATIENT_TYPE = {number}").drop("PATIENT_TYPE")
        assert side.count() == whole.count() > 0
        assert side.exceptAll(whole).isEmpty()
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.rindex("Join"):]
        assert re.search(r"Filter .*l_returnflag", plan), plan
        assert re.search(r"Filter .*o_orderpriority", plan) and below


def _numbers(spark, rows=3000, seed=3):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 40, rows), draw.normal(size=rows).round(3), draw.integers(0, 2, rows), draw.random(rows)])
    y = ((x[:, 0] > 17).astype(int) + (x[:, 1] > 0.3) + draw.integers(0, 10, rows) // 9).astype(float)
    data = [(i, [float(a) for a in v], float(c), float(c + 0.1 * a), float(1 + c)) for i, (v, c, a) in enumerate(zip(x, y, x[:, 3]))]
    return spark.createDataFrame(data, "id long, features array<double>, label double, number double, weight double").withColumn("features", array_to_vector("features")).repartition(6).cache()


@pytest.mark.parametrize("kind", [forest.ForestClassifier, forest.ForestRegressor])
def test_large_nodes_split_as_small_ones(spark, monkeypatch, kind):
    """Histograms of large nodes and the growth of small ones in tasks give the same trees."""
    rows = _numbers(spark)
    label = {"labelCol": "label", "weightCol": "weight"} if kind is forest.ForestClassifier else {"labelCol": "number"}
    found = []
    stored = as_table(rows, "rows")
    for limit in (10**6, 300):
        monkeypatch.setattr(forest, "LOCAL_ROWS", limit)
        model = kind(numTrees=5, maxDepth=9, minInstancesPerNode=3, featureSubsetStrategy="0.5", maxBins=64, seed=1, **label).fit(stored)
        if limit == 300:
            assert model.table.count() > 10
            # The slices of the model are added up to the same votes.
            before = model.transform(stored).orderBy("id").toPandas()["prediction"]
            monkeypatch.setattr(forest, "SLICE_BYTES", 20_000)
            assert len(model._slices()) > 1
            assert np.allclose(before, model.transform(stored).orderBy("id").toPandas()["prediction"])
        found.append(model.nodes().orderBy("tree", "node").toPandas())
    assert len(found[0]) == len(found[1]) > 100
    # Two features that part the same rows gain the same but for rounding.
    for c in ("tree", "node", "left", "right", "feature", "threshold"):
        assert (found[0][c].fillna(0) == found[1][c].fillna(0)).mean() > 0.99, c
    for c in ("cover", "gain"):
        assert np.isclose(found[0][c], found[1][c]).mean() > 0.99


def test_forest_is_as_good_as_mllib(spark):
    train, test = _numbers(spark), _numbers(spark, 2000, 4)
    settings = dict(numTrees=30, maxDepth=10, minInstancesPerNode=2, maxBins=64, seed=1)
    share = lambda m: m.transform(test).filter("prediction = label").count() / 2000
    own = share(forest.ForestClassifier(featureSubsetStrategy="sqrt", **settings).fit(train))
    theirs = share(RandomForestClassifier(featureSubsetStrategy="sqrt", **settings).fit(train))
    assert abs(own - theirs) < 0.02
    error = lambda m: m.transform(test).agg(F.avg((F.col("prediction") - F.col("number")) ** 2)).first()[0]
    model = forest.ForestRegressor(featureSubsetStrategy="all", labelCol="number", **settings).fit(train)
    other = RandomForestRegressor(featureSubsetStrategy="all", labelCol="number", **settings).fit(train)
    assert abs(error(model) / error(other) - 1) < 0.1
    assert np.allclose(model.featureImportances, other.featureImportances.toArray(), atol=0.03)


@pytest.mark.parametrize("offset", [0.0, 1e5])
def test_nearest_rows_are_those_of_all_distances(offset):
    draw = np.random.default_rng(5)
    b = np.vstack([draw.integers(0, 3, (300, 4)), draw.normal(size=(300, 4))]) + offset
    a = np.vstack([b[::7], draw.normal(size=(40, 4)) + offset])
    for k in (1, 5, 599, 600, 700):
        gaps = np.round(np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)), knn.DIGITS)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :k]
        row, place, distance = knn._nearest_rows(a, b, k)
        assert np.array_equal(row, np.repeat(np.arange(len(a)), order.shape[1]))
        assert np.allclose(distance, np.take_along_axis(gaps, order, axis=1).ravel(), atol=2e-9)
        assert (place == order.ravel()).mean() > 0.999


def test_vectors_that_no_split_tells_apart_are_explained_once(spark, monkeypatch):
    nodes = spark.createDataFrame(
        [(0, 1, 2, 3, 0, 0.5, 8.0, [0.0]), (0, 2, -1, -1, -1, None, 3.0, [1.0]), (0, 3, -1, -1, -1, None, 5.0, [4.0])],
        tree_attribution.NODES,
    )
    vectors = spark.range(1000).select(F.array(F.col("id") / 1000.0, F.col("id") * 1.0).alias("__x"))
    rows, add = [], tree_attribution._add

    def counted(state, *rest):
        rows.append(state.count())
        return add(state, *rest)

    monkeypatch.setattr(tree_attribution, "_add", counted)
    found = tree_attribution.tree_values(nodes, vectors, 2, 1).collect()
    assert rows == [2] and len(found) == 1000
    for r in found:
        out = 1.0 if r["__x"][0] <= 0.5 else 4.0
        assert np.allclose(r["shap"], [[out - 23 / 8], [0.0]]) and np.allclose(r["base"], [23 / 8])
