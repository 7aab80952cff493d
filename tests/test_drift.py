"""Drift statistics against numpy."""

import random

import numpy as np
import pytest

from claimloom.operators import drift


@pytest.fixture(scope="module")
def frames(spark):
    draw = random.Random(11)
    ref = [(round(draw.gauss(0, 1), 2), draw.choice("aab")) for _ in range(500)]
    cur = [(round(draw.gauss(0.8, 1), 2), draw.choice("abbc")) for _ in range(300)]
    kinds = "x double, c string"
    return ref, cur, spark.createDataFrame(ref, kinds), spark.createDataFrame(cur, kinds)


def test_numeric_statistics(frames):
    ref, cur, a, b = frames
    row, = drift.numeric_drift(a, b, ["x"]).collect()
    u, v = np.array([r[0] for r in ref]), np.array([r[0] for r in cur])
    grid = np.unique(np.concatenate([u, v]))
    gap = np.abs(
        np.searchsorted(np.sort(u), grid, "right") / len(u)
        - np.searchsorted(np.sort(v), grid, "right") / len(v)
    )
    assert row.ks == pytest.approx(gap.max())
    assert row.wasserstein == pytest.approx((gap[:-1] * np.diff(grid)).sum() / u.std())


def test_categorical_statistics(frames):
    ref, cur, a, b = frames
    row, = drift.categorical_drift(a, b, ["c"]).collect()
    n = np.array([[sum(r[1] == k for r in rows) for k in "abc"] for rows in (ref, cur)], dtype=float)
    p, q = n[0] / n[0].sum(), n[1] / n[1].sum()
    m = (p + q) / 2

    def kl(x):
        return sum(xi * np.log2(xi / mi) for xi, mi in zip(x, m) if xi > 0)

    assert row.jensen_shannon == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    expected = n.sum(axis=1, keepdims=True) * n.sum(axis=0) / n.sum()
    assert row.chi_square == pytest.approx(((n - expected) ** 2 / expected).sum())


def test_equal_tables_do_not_drift(frames):
    _, _, a, _ = frames
    numeric, texts = drift.column_roles(a)
    assert (numeric, texts) == (["x"], ["c"])
    summary = drift.summarise(drift.column_scores(a, a, numeric, texts)).first()
    assert (summary.drifted_columns, summary["columns"], summary.drifted_share) == (0, 2, 0.0)


def test_shifted_tables_drift(frames):
    _, _, a, b = frames
    scores = {r.column_name: r for r in drift.column_scores(a, b, ["x"], ["c"]).collect()}
    assert scores["x"].drifted and scores["c"].drifted
    assert scores["x"].statistic == "wasserstein" and scores["c"].statistic == "jensen_shannon"


def test_roles_can_be_stated(frames):
    _, _, a, _ = frames
    assert drift.column_roles(a, categorical=["x"]) == (["c"], ["x"])
    assert drift.column_roles(a, numeric=["c"]) == (["x", "c"], [])


def test_batches_equal_separate_comparisons(frames):
    from pyspark.sql import functions as F

    _, _, a, b = frames
    batches = b.withColumn("batch", (F.col("x") > 0.5).cast("int"))
    got = {r.batch: r.jensen_shannon for r in drift.batch_drift(a, batches, "batch", ["c"], {}).collect()}
    for i in (0, 1):
        alone = drift.categorical_drift(a, batches.filter(F.col("batch") == i), ["c"]).first()
        assert got[i] == pytest.approx(alone.jensen_shannon)


def test_empty_columns_are_full_drift(spark):
    """All rows of a column null in one table, in the other, in both."""
    kinds = "a double, b double, c double, t string, u string, v string"
    ref = spark.createDataFrame([(None, float(i), None, None, "x", None) for i in range(20)], kinds)
    cur = spark.createDataFrame([(float(i), None, float("nan"), "y", None, None) for i in range(10)], kinds)
    numeric = {r.column_name: r for r in drift.numeric_drift(ref, cur, ["a", "b", "c"]).collect()}
    assert [(numeric[c].wasserstein, numeric[c].ks) for c in "abc"] == [(1, 1), (1, 1), (0, 0)]
    texts = {r.column_name: r.jensen_shannon for r in drift.categorical_drift(ref, cur, ["t", "u", "v"]).collect()}
    assert texts == {"t": 1, "u": 1, "v": 0}
    scores = drift.column_scores(ref, cur, ["a", "b", "c"], ["t", "u", "v"]).collect()
    assert {r.column_name for r in scores if r.drifted} == {"a", "b", "t", "u"} and len(scores) == 6


def test_empty_batches_are_full_drift(spark):
    ref = spark.createDataFrame([("x", None), ("x", None), ("y", None)], "c string, d string")
    rows = [(1, "x", None), (1, "y", "z"), (2, None, None), (2, None, None)]
    cur = spark.createDataFrame(rows, "batch int, c string, d string")
    found = drift.batch_drift(ref, cur, "batch", ["c", "d"], {}).collect()
    got = {(r.batch, r.column_name): (r.rows, r.jensen_shannon) for r in found}
    assert got[1, "c"][0] == 2 and 0 < got[1, "c"][1] < 0.3
    assert got[1, "d"] == (1, 1) and got[2, "c"] == (0, 1) and got[2, "d"] == (0, 0) and len(got) == 4


def test_reference_bins_are_even(frames):
    from pyspark.sql import functions as F

    _, _, a, _ = frames
    edges = drift.reference_bins(a, "x", 4)
    sizes = a.groupBy(drift.bin_of(F.col("x"), edges)).count().collect()
    assert len(edges) == 3 and all(115 <= r["count"] <= 135 for r in sizes)
