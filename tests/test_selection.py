"""Quantiles by selection, cuts as a table and samples by stratum."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.functions import ranks
from claimloom.operators import splits

SHARES = {"least": 0.0, "a": 0.1, "b": 0.5, "c": 0.77, "most": 1.0}


def expected(values):
    values = sorted(values)
    found = []
    for share in SHARES.values():
        at = share * (len(values) - 1)
        low, high = values[math.floor(at)], values[math.ceil(at)]
        found.append(low if low == high else low + (high - low) * (at - math.floor(at)))
    return found


def quantiles(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g string, v double")
    return {r.g: list(r[1:]) for r in ranks.exact_quantiles(frame, ["g"], "v", SHARES).collect()}


@pytest.fixture
def tiny_bins(monkeypatch):
    """Many rounds: bins of more than 5 rows are looked into again."""
    monkeypatch.setattr(ranks, "WINDOW_ROWS", 5)
    monkeypatch.setattr(ranks, "BINS", 8)


def test_values_of_any_magnitude(spark, tiny_bins):
    draw = random.Random(3)
    groups = {
        "wide": [draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(300)],
        "negative": [-(10.0 ** draw.uniform(-5, 9)) for _ in range(200)],
        "near": [1.0 + i * 2.0**-52 for i in range(100)],
        "tiny": [i * 5e-324 for i in range(60)],
        "zeros": [0.0] * 90 + [-0.0] * 9 + [1e-9, 5.0, -3.0],
        "equal": [7.25] * 80,
        "one": [4.0],
        None: [float(i % 11) for i in range(70)],
    }
    got = quantiles(spark, groups)
    assert set(got) == set(groups)
    for name, values in groups.items():
        assert got[name] == expected(values), name


def test_infinities_have_a_place(spark, tiny_bins):
    largest = float(np.finfo(float).max)
    values = [math.inf] * 20 + [-math.inf] * 20 + [largest] * 20 + [-largest] * 7 + [0.5] * 70
    got = quantiles(spark, {"x": values})["x"]
    assert got == [-math.inf, -math.inf, 0.5, largest, math.inf]


def test_only_values_without_an_order(spark):
    assert quantiles(spark, {"x": [None, math.nan]}) == {}
    assert quantiles(spark, {}) == {}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_subnormal=True), min_size=1, max_size=60))
def test_any_values(spark, tiny_bins, values):
    assert quantiles(spark, {"x": values})["x"] == expected(values)


def test_ten_thousand_strata_in_one_small_plan(spark):
    rows = spark.range(40_000).select((F.col("id") % 10_000).alias("s"), F.col("id").cast("string").alias("t"))
    rows = rows.withColumn("s", F.when(F.col("s") > 0, F.col("s")))
    folds = splits.stratified_split(rows, "s", [F.col("t")], share=0.5)
    plan = folds._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 5_000
    train = folds.filter("fold = 'train'").groupBy("s").count()
    assert train.count() == 10_000 and train.filter("count <> 2").count() == 0
    assert folds.columns == ["s", "t", "copy_no", "fold"]


def test_sample_by_takes_the_fraction_of_each_stratum(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("s"), F.col("id").cast("string").alias("t")
    )
    fractions = spark.createDataFrame([(None, 1.0), (1, 0.2), (2, None)], "s long, fraction double")
    taken = splits.sample_by(rows, "s", fractions, [F.col("t")])
    assert taken.columns == rows.columns
    sizes = {r.s: r["count"] for r in taken.groupBy("s").count().collect()}
    assert sizes[None] == 10_000 and 1_800 < sizes[1] < 2_200 and set(sizes) == {None, 1}
    again = splits.sample_by(rows.repartition(7), "s", fractions, [F.col("t")])
    assert {r.t for r in taken.collect()} == {r.t for r in again.collect()}
