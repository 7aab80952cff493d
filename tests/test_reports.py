"""Coefficient errors, dropped rows, mergeable sketches and tables laid out by key."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.__main__ import main
from claimloom.operators import dropped, inference, rollup, sketches, splits
from claimloom.plans import training
from claimloom.sources import bundles, tables
from claimloom.streaming import drift as stream_drift


def regression_rows(n=300, seed=4):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3)) * [1, 5, 0.1]
    y = 2 + x @ [0.5, 0.0, -3.0] + draw.normal(size=n)
    return x, y, draw.integers(1, 4, n).astype(float)


@pytest.mark.parametrize("weighted", [False, True])
def test_coefficients_equal_the_normal_equations(spark, weighted):
    x, y, w = regression_rows()
    flag = (x[:, 0] > 0).astype(float)
    rows = [
        (Vectors.dense(*a, f, 1 - f, 7.0), float(b), float(c)) for a, f, b, c in zip(x.tolist(), flag.tolist(), y, w)
    ]
    frame = spark.createDataFrame(rows, ["features", "y", "w"])
    names = ["a", "b", "c", "yes", "no", "constant"]
    got = inference.coefficient_table(frame, names, "y", weight="w" if weighted else None, left_out=["no"]).collect()
    design = np.column_stack([np.ones(len(y)), x, flag])
    weights = w if weighted else np.ones(len(y))
    inverse = np.linalg.inv(design.T @ (design * weights[:, None]))
    beta = inverse @ (design.T @ (weights * y))
    scale = (weights * (y - design @ beta) ** 2).sum() / (len(y) - design.shape[1])
    errors = np.sqrt(scale * np.diag(inverse))
    assert [r.term for r in got] == [inference.INTERCEPT, *names]
    assert [r.estimate for r in got[:5]] == pytest.approx(list(beta))
    assert [r.std_error for r in got[:5]] == pytest.approx(list(errors))
    assert [r.t_value for r in got[:5]] == pytest.approx(list(beta / errors))
    assert got[3].p_value < 1e-3 and all(0 <= r.p_value <= 1 for r in got[:5])
    assert all(r.estimate is None and r.p_value is None for r in got[5:])


def test_coefficients_need_independent_columns_and_rows(spark):
    x, y, _ = regression_rows(60)
    both = spark.createDataFrame([(Vectors.dense(a[0], 2 * a[0]), float(b)) for a, b in zip(x, y)], ["features", "y"])
    with pytest.raises(ValueError):
        inference.coefficient_table(both, ["a", "twice"], "y")
    few = both.limit(2)
    with pytest.raises(ValueError, match="2 rows"):
        inference.coefficient_table(few, ["a", "twice"], "y")
    with pytest.raises(ValueError, match="0 rows"):
        inference.coefficient_table(both.limit(0), ["a", "twice"], "y")


def null_rows(n=500, seed=8):
    draw = random.Random(seed)
    return [tuple(None if draw.random() < share else draw.randint(0, 9) for share in (0.1, 0.3, 0.0)) for _ in range(n)]


def test_drop_report_counts_what_is_lost(spark):
    data = null_rows()
    rows, report = dropped.store_complete(spark.createDataFrame(data, "a int, b int, c int").repartition(5))
    assert rows.count() == sum(None not in r for r in data)
    got = {r.column_name: tuple(r[1:]) for r in report.collect()}
    lost = sum(None in r for r in data)
    for i, name in enumerate("abc"):
        nulls = sum(r[i] is None for r in data)
        alone = sum(r[i] is None and sum(v is None for v in r) == 1 for r in data)
        assert got[name] == (len(data), lost, nulls, alone)


def test_drop_report_of_some_columns_and_of_no_rows(spark):
    frame = spark.createDataFrame(null_rows(), "a int, b int, c int")
    rows, report = dropped.store_complete(frame, ["a"])
    assert [r.column_name for r in report.collect()] == ["a"]
    assert rows.filter("b IS NULL").count() > 0 and report.first().dropped == report.first().nulls
    rows, report = dropped.store_complete(frame.filter("c > 100"))
    assert rows.count() == 0 and [tuple(r[1:]) for r in report.collect()] == [(0, 0, 0, 0)] * 3
    rows, report = dropped.store_complete(frame.limit(0))
    assert rows.count() == 0 and [tuple(r[1:]) for r in report.collect()] == [(0, 0, 0, 0)] * 3


def test_rollup_job_writes_the_report(spark, tmp_path):
    head = "BENE_ID,CLM_ID,PRVDR_STATE_CD,PRVDR_NUM,PRNCPAL_DGNS_CD,CLM_TOT_CHRG_AMT,CLM_E_POA_IND_SW1"
    (tmp_path / "inp.csv").write_text(f"{head}\n-1,10,5,x,A100,100.00,Y\n1,11,5,x,,50.00,Y\n2,12,6,x,,70.00,\n")
    (tmp_path / "out.csv").write_text(f"{head}\n1,20,5,x,B200,30.00,\n")
    out, drops = str(tmp_path / "claims"), str(tmp_path / "report")
    main([
        "rollup", "--inpatient", str(tmp_path / "inp.csv"), "--outpatient", str(tmp_path / "out.csv"),
        "--output", out, "--drops", drops,
    ])
    assert spark.read.parquet(out).count() == 1
    got = {r.column_name: (r.rows, r.dropped, r.nulls, r.dropped_by_it_alone)
           for r in spark.read.parquet(f"{drops}/drops").collect()}
    assert got["PRNCPAL_DGNS_CD"] == (3, 2, 2, 1) and got["CLM_E_POA_IND_SW1"] == (3, 2, 1, 0)


def test_training_folds_report_nulls(spark, modeling, tmp_path):
    rows = modeling.withColumn(S.INCOME, F.when(F.col("BENE_ID") > 3, F.col(S.INCOME)))
    train, test, report = training.split_with_report(rows)
    bundles.save_metadata({"nulls": report.table(spark)}, str(tmp_path))
    found = {r.column_name: r for r in bundles.load_table(spark, str(tmp_path), "nulls").collect()}
    assert set(found) == set(modeling.columns)
    assert found[S.INCOME].nulls == rows.filter(F.col(S.INCOME).isNull()).count() > 0
    assert found[S.INCOME].rows == train.count() + test.count() == modeling.count()


def rank_gap(values, quantile, share):
    """Distance of the wanted rank from the ranks that ``quantile`` has among ``values``."""
    low, high = (np.searchsorted(values, quantile, side) / len(values) for side in ("left", "right"))
    return max(low - share, share - high, 0)


def test_merged_sketches_keep_their_error(spark):
    draw = np.random.default_rng(1)
    values = np.concatenate([draw.lognormal(0, 3, 60_000), np.full(20_000, 2.5)])
    draw.shuffle(values)
    rows = [(int(i % 40), float(v)) for i, v in enumerate(values)] + [(1, None), (2, float("nan"))]
    frame = spark.createDataFrame(rows, "part int, v double")
    parts = sketches.column_sketches(frame, ["v"], ["part"], k=200)
    assert parts.count() == 40
    whole = sketches.merged(parts, k=200)
    shares = [i / 20 for i in range(21)]
    got = sketches.sketch_quantiles(whole, shares).collect()
    assert {r.rows for r in got} == {80_000} and len(got) == 21
    values.sort()
    # The bound holds in 99 of 100 cases; none of these is beyond twice of it.
    gaps = [rank_gap(values, r["quantile"], r.share) for r in got]
    assert max(gaps) < 2 * sketches.rank_error(200) and sorted(gaps)[-3] <= sketches.rank_error(200)
    # A sketch holds far fewer bytes than the values it has seen.
    assert whole.select(F.octet_length("sketch")).first()[0] < 80_000 * 8 / 50


def test_sketch_drift_is_near_the_exact_distance(spark):
    draw = np.random.default_rng(2)
    reference, moved = draw.normal(0, 1, 20_000), draw.normal(0.5, 1, 20_000)
    both = spark.createDataFrame(
        [("old", float(v)) for v in reference] + [("new", float(v)) for v in moved], "side string, v double"
    )
    by_side = sketches.column_sketches(both, ["v"], ["side"])
    known = by_side.filter("side = 'old'").drop("side")
    got = {r.side: r.ks for r in sketches.sketch_drift(by_side, known, ["side"]).collect()}
    grid = np.sort(np.concatenate([reference, moved]))
    exact = np.abs(
        np.searchsorted(np.sort(reference), grid, "right") - np.searchsorted(np.sort(moved), grid, "right")
    ).max() / 20_000
    # Each side is sketched anew whenever it is read, so even the reference is not at zero.
    assert got["old"] < 2 * sketches.rank_error() and abs(got["new"] - exact) < 2 * sketches.rank_error() + 0.01


def test_stream_sketches_merge_over_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        lines = [json.dumps({"ts": f"2024-01-0{1 + j % 2} 10:00:00", "v": 100 * i + j}) for j in range(100)]
        (folder / f"{i}.json").write_text("\n".join(lines))
    rows = spark.readStream.schema("ts timestamp, v double").option("maxFilesPerTrigger", 1).json(str(folder))
    out = str(tmp_path / "out")
    query = stream_drift.start_window_sketches(rows, "ts", ["v"], "1 day", out, str(tmp_path / "cp"))
    query.awaitTermination(180)
    assert query.exception() is None
    stored = spark.read.parquet(out)
    assert stored.count() == 6 and stored.select("batch_id").distinct().count() == 3
    windows = stream_drift.merged_windows(stored)
    got = {str(r.window_start)[:10]: r for r in sketches.sketch_quantiles(windows, [0.5], ["window_start"]).collect()}
    # Up to k values a sketch is exact.
    assert {d: (r.rows, r["quantile"]) for d, r in got.items()} == {"2024-01-01": (150, 148.0), "2024-01-02": (150, 149.0)}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_tables_laid_out_by_person_need_no_exchange(spark, claims, tmp_path, no_broadcast):
    for name in ("left_side", "right_side"):
        assert tables.write_by_key(claims, name, str(tmp_path / name), buckets=4, hot_share=2.0)
    left, right = spark.table("left_side"), spark.table("right_side")
    assert sorted(map(str, left.collect())) == sorted(map(str, claims.select(left.columns).collect()))
    people = left.groupBy(S.GROUP_KEY).count()
    names = ["CLM_TOT_CHRG_AMT_inp"]
    joined = rollup.suffixed(left, "_a", names).select(S.GROUP_KEY, "CLM_TOT_CHRG_AMT_inp_a").join(
        right.select(S.GROUP_KEY, *names), S.GROUP_KEY
    )
    for frame in (people, joined, left.select(S.GROUP_KEY).distinct()):
        assert "Exchange" not in plan(frame)
    assert "Exchange" in plan(claims.groupBy(S.GROUP_KEY).count())
    assert joined.count() == claims.join(claims.select(S.GROUP_KEY), S.GROUP_KEY).count()
    got = splits.group_split(left).filter("fold = 'test'").select(S.GROUP_KEY).distinct()
    wanted = splits.group_split(claims).filter("fold = 'test'").select(S.GROUP_KEY).distinct()
    assert set(got.collect()) == set(wanted.collect())
    for name in ("left_side", "right_side"):
        spark.sql(f"DROP TABLE {name}")


def test_a_hot_key_is_not_put_in_one_bucket(spark, tmp_path):
    rows = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias(S.GROUP_KEY), "id")
    assert not tables.write_by_key(rows, "hot_side", str(tmp_path / "hot"), buckets=8)
    assert spark.table("hot_side").count() == 900
    empty = rows.limit(0)
    assert tables.write_by_key(empty, "hot_side", str(tmp_path / "hot"), buckets=8)
    assert spark.table("hot_side").count() == 0
    spark.sql("DROP TABLE hot_side")
