"""Nearest neighbours against brute force."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from claimloom.operators import knn


def frame_of(spark, points, start=0):
    rows = [(start + i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, vec array<double>")


def brute(queries, base, k):
    result = set()
    for i, q in enumerate(queries):
        gaps = np.round(np.sqrt(((base - q) ** 2).sum(axis=1)), knn.DIGITS)
        for rank, j in enumerate(np.lexsort((np.arange(len(base)), gaps))[:k], 1):
            result.add((i, int(j), float(gaps[j]), rank))
    return result


@pytest.mark.parametrize("block", [4096, 7])
def test_join_is_exact_with_copies_and_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    monkeypatch.setattr(knn, "RING_ROWS", 5)
    draw = np.random.default_rng(4)
    base = np.vstack([draw.normal(0, 1, (120, 3)), draw.normal(9, 0.2, (80, 3)), np.zeros((100, 3))])
    base = base[draw.permutation(len(base))]
    queries = np.vstack([draw.normal(0, 2, (30, 3)), np.zeros((20, 3)), draw.normal(50, 1, (3, 3))])
    near = knn.knn_join(frame_of(spark, queries), frame_of(spark, base), 6).collect()
    assert {(r.id, r.neighbour, r.distance, r["rank"]) for r in near} == brute(queries, base, 6)


def test_fewer_base_rows_than_k(spark):
    near = knn.knn_join(frame_of(spark, [[0.0]]), frame_of(spark, [[1.0], [2.0]]), 5).collect()
    assert sorted((r.neighbour, r["rank"]) for r in near) == [(0, 1), (1, 2)]


def test_own_row_is_left_out(spark):
    rows = frame_of(spark, [[0.0], [0.0], [0.0], [5.0]])
    near = knn.knn_join(rows, rows, 2, exclude_self=True).collect()
    assert all(r.id != r.neighbour for r in near)
    assert sorted(r.neighbour for r in near if r.id == 3) == [0, 1]


def test_vote_weights(spark):
    rows = [(1, 1.0, 0), (1, 0.5, 1), (1, 2.0, 0), (2, 0.0, 1), (2, 0.1, 0), (2, 0.1, 0)]
    near = spark.createDataFrame(rows, "id int, distance double, label int")
    shares = {r.id: r for r in knn.vote(near, [0, 1]).collect()}
    assert shares[1].shares == pytest.approx([1.5 / 3.5, 2 / 3.5]) and shares[1].prediction == 1
    assert shares[2].shares == pytest.approx([0, 1]) and shares[2].prediction == 1
    plain = {r.id: r.prediction for r in knn.vote(near, [0, 1], weighted=False).collect()}
    assert plain == {1: 0, 2: 0}


def test_majority_of_equal_rows_wins(spark):
    """5 rows of the lowest class and 95 of the highest on one vector."""
    rows = [(Vectors.dense([1.0, 2.0]), 0.0 if i % 20 == 3 else 4.0) for i in range(100)]
    frame = spark.createDataFrame(rows, ["features", "label"])
    row = knn.NeighbourClassifier(k=5).fit(frame).transform(frame.limit(1)).first()
    assert row.prediction == 4.0 and row.probability[4] >= 0.6


def test_classifier_saves_and_scores(spark, tmp_path):
    draw = np.random.default_rng(1)
    rows = [
        (i, Vectors.dense(draw.normal(5 * (i % 2), 1, 2)), float(i % 2)) for i in range(120)
    ] + [(500 + i, Vectors.dense([0.0, 0.0]), 0.0) for i in range(60)]
    frame = spark.createDataFrame(rows, ["id", "features", "label"])
    model = knn.NeighbourClassifier(k=5).fit(frame)
    scored = model.transform(frame)
    assert scored.count() == 180
    assert scored.filter("prediction = label").count() > 170
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in scored.collect())
    model.write().overwrite().save(str(tmp_path / "knn"))
    again = knn.NeighbourModel.load(str(tmp_path / "knn")).transform(frame)
    key = lambda rows: sorted((r.id, r.prediction) for r in rows)
    assert key(again.collect()) == key(scored.collect())


def test_rings_prune_clustered_vectors(spark, monkeypatch):
    """Few of all pairs are compared, and none is missed."""
    monkeypatch.setattr(knn, "RING_ROWS", 20)
    draw = np.random.default_rng(6)
    centres = draw.normal(0, 20, (25, 6))
    base = np.vstack([c + draw.normal(0, 0.5, (60, 6)) for c in centres])
    queries = base[::7] + draw.normal(0, 0.1, base[::7].shape)
    report = {}
    near = knn.knn_join(frame_of(spark, queries), frame_of(spark, base), 5, report=report).collect()
    assert {(r.id, r.neighbour, r.distance, r["rank"]) for r in near} == brute(queries, base, 5)
    assert report["all"] == len(base) * len(queries) and report["compared"] < 0.25 * report["all"]


def test_layout_does_not_choose_copies(spark):
    rows = [(Vectors.dense([float(i % 3)]), float(i % 5)) for i in range(200)]
    frame = spark.createDataFrame(rows, ["features", "label"])
    asked = frame.select("features").distinct()
    answers = [
        sorted((tuple(r.features), tuple(r.probability)) for r in knn.NeighbourClassifier(k=5).fit(f).transform(asked).collect())
        for f in (frame, frame.orderBy("label").repartition(7))
    ]
    assert answers[0] == answers[1]


def test_approximate_join_has_measured_recall(spark):
    draw = np.random.default_rng(9)
    centres = draw.normal(0, 3, (12, 16))
    base = np.vstack([c + draw.normal(0, 1, (40, 16)) for c in centres])
    rows = frame_of(spark, base).cache()
    exact = knn.knn_join(rows, rows, 10, exclude_self=True).cache()
    found = knn.approximate_knn_join(rows, rows, 10, exclude_self=True).cache()
    distances = {(r.id, r.neighbour): r.distance for r in exact.collect()}
    assert knn.recall(found, exact) >= 0.9 and knn.recall(exact, exact) == 1
    assert all(distances.get((r.id, r.neighbour), r.distance) == r.distance for r in found.collect())
    assert knn.approximate_knn_join(rows.limit(0), rows, 3).collect() == []


def test_recall_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("given tables are not here")
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").selectExpr("vec_id AS id", "CAST(embedding AS array<double>) AS vec")
    exact = knn.knn_join(rows, rows, 10, exclude_self=True)
    assert knn.recall(knn.approximate_knn_join(rows, rows, 10, exclude_self=True), exact) >= 0.9
