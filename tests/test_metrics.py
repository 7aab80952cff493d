"""Metrics against brute force and MLlib."""

import itertools
import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import metrics


@pytest.fixture(scope="module")
def predictions(spark):
    draw = random.Random(9)
    rows = []
    for _ in range(400):
        truth = draw.choice([0, 0, 0, 1, 2])
        p = [round(draw.random() + (0.4 if c == truth else 0), 1) for c in range(3)]
        rows.append((truth, float(p.index(max(p))), *p))
    frame = spark.createDataFrame(rows, "label int, prediction double, p0 double, p1 double, p2 double")
    return rows, frame.cache()


def brute_auc(pos, neg):
    won = sum((a > b) + (a == b) / 2 for a, b in itertools.product(pos, neg))
    return won / (len(pos) * len(neg))


def test_classification_metrics_equal_mllib(predictions):
    rows, frame = predictions
    row = metrics.classification_metrics(frame).first()
    doubled = frame.withColumn("label", F.col("label").cast("double"))
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_f1", "f1")):
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(doubled)
        assert row[ours] == pytest.approx(value)
    f1 = []
    for c in range(3):
        hits = sum(r[0] == c and r[1] == c for r in rows)
        f1.append(2 * hits / (sum(r[0] == c for r in rows) + sum(r[1] == c for r in rows)))
    assert row.macro_f1 == pytest.approx(sum(f1) / 3)
    assert metrics.MacroF1Evaluator().evaluate(frame) == pytest.approx(row.macro_f1)
    assert row.selection_score == pytest.approx(0.6 * row.macro_f1 + 0.4 * row.accuracy)


def test_class_predicted_but_never_true_counts_as_zero(spark):
    frame = spark.createDataFrame([(0, 0.0), (0, 1.0)], "label int, prediction double")
    assert metrics.classification_metrics(frame).first().macro_f1 == pytest.approx((2 / 3 + 0) / 2)


def test_auc_equals_pair_counting(predictions):
    rows, frame = predictions
    scores = {c: f"p{c}" for c in range(3)}
    wanted = [
        brute_auc([r[2 + c] for r in rows if r[0] == c], [r[2 + c] for r in rows if r[0] != c])
        for c in range(3)
    ]
    got = {r.cls: r.auc for r in metrics.roc_auc_by_class(frame, scores).collect()}
    assert [got[c] for c in range(3)] == pytest.approx(wanted)
    assert metrics.roc_auc_ovr(frame, scores).first()[0] == pytest.approx(sum(wanted) / 3)
    own = frame.withColumn("y", (F.col("label") == 1).cast("double"))
    theirs = BinaryClassificationEvaluator(rawPredictionCol="p1", labelCol="y", numBins=0).evaluate(own)
    assert got[1] == pytest.approx(theirs)
    pairs = [
        brute_auc([r[2 + i] for r in rows if r[0] == i], [r[2 + i] for r in rows if r[0] == j])
        for i in range(3) for j in range(3) if i != j
    ]
    assert metrics.hand_till_auc(frame, scores).first()[0] == pytest.approx(sum(pairs) / 6)


def test_auc_is_left_out_when_a_class_is_absent(predictions):
    _, frame = predictions
    scores = {0: "p0", 1: "p1", 2: "p2", 3: "p0"}
    assert metrics.roc_auc_ovr(frame, scores).first() is None


def test_confusion_matrix_is_square_over_all_labels(spark):
    frame = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "label int, prediction int")
    rows = metrics.confusion_matrix(frame, S.TIERS).collect()
    assert [r.truth for r in rows] == [f"true_{t}" for t in S.TIERS]
    assert list(rows[2])[1:] == [1, 0, 0, 0, 0] and list(rows[4])[1:] == [0] * 5


def test_kappa(spark):
    cells = {(0, 0): 20, (0, 1): 5, (1, 0): 10, (1, 1): 15}
    frame = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "label int, prediction int")
    row = {r["class"]: r for r in metrics.agreement_report(frame).collect()}
    assert row[0].kappa == pytest.approx(0.4)
    assert row[0].sensitivity == pytest.approx(0.8) and row[0].specificity == pytest.approx(0.6)


def test_perfect_regression_has_no_error(spark):
    frame = spark.createDataFrame([(math.log(1000.0),) * 2, (math.log(10_000.0),) * 2],
                                  "label double, prediction double")
    row = metrics.regression_metrics(frame).first()
    assert row.rmse_log == 0 and row.mae_log == 0 and row.median_abs_dollar_error == 0
    assert row.r2_log == pytest.approx(1.0)
    near = metrics.median_dollar_error(frame, approximate=True).first()[0]
    assert near == 0


def test_selection_prefers_macro_f1_and_the_first_on_ties(spark):
    rows = [(0, "blind", 0.80, 0.40), (1, "balanced", 0.75, 0.70), (2, "late", 0.75, 0.70)]
    frame = spark.createDataFrame(rows, "ordinal int, model string, accuracy double, macro_f1 double")
    scored = frame.withColumn("selection_score", metrics.selection_score())
    assert metrics.select_best(scored).first().model == "balanced"
    assert metrics.select_best(scored, "accuracy", lowest=True).first().model == "balanced"
