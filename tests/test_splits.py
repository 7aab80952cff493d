"""Splits, folds and samples: no leaks, exact shares, repeatable."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import splits

TEXTS = ["BENE_ID", "PRNCPAL_DGNS_CD_inp", "PRNCPAL_DGNS_CD_out", "Number_of_Claims_inp"]


def texts():
    return [F.col(c).cast("string") for c in TEXTS]


def test_group_split_shares_no_key_and_loses_no_row(modeling):
    train, test = splits.split_by_beneficiary(modeling)
    keys = [{r[0] for r in x.select(S.GROUP_KEY).distinct().collect()} for x in (train, test)]
    assert not keys[0] & keys[1]
    assert train.count() + test.count() == modeling.count()
    assert len(keys[1]) == math.ceil(0.3 * len(keys[0] | keys[1]))
    splits.require_disjoint(splits.group_split(modeling))


def test_group_split_by_threshold_is_near_the_share(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    test = splits.group_split(keys, "k", exact=False).filter("fold = 'test'").count()
    assert 1350 < test < 1650


def test_naive_split_leaks_and_the_check_sees_it(modeling):
    rows = modeling.select(*TEXTS)
    naive = splits.naive_split(rows, texts())
    assert naive.count() == rows.count()
    assert naive.filter("fold = 'test'").count() == math.ceil(0.3 * rows.count())
    assert splits.shared_keys(naive).count() > 0
    with pytest.raises(ValueError, match="leaked"):
        splits.require_disjoint(naive)


def test_naive_split_handles_many_copies(spark):
    rows = spark.createDataFrame([(1, "a")] * 600 + [(i, "b") for i in range(400)], "BENE_ID long, x string")
    naive = splits.naive_split(rows, [F.col("BENE_ID").cast("string"), F.col("x")])
    assert naive.filter("fold = 'test'").count() == 300


def folds_of(frame, k, key=S.GROUP_KEY):
    folded = splits.group_kfold(frame, key, k)
    per_key = folded.groupBy(key).agg(F.count_distinct("fold").alias("n")).filter("n > 1").count()
    return per_key, Counter(dict(map(tuple, folded.groupBy("fold").count().collect())))


def test_group_kfold_is_disjoint_and_even(modeling):
    leaked, sizes = folds_of(modeling, 3)
    assert leaked == 0 and sum(sizes.values()) == modeling.count()
    assert max(sizes.values()) - min(sizes.values()) <= 40


def test_group_kfold_with_one_very_heavy_key(spark):
    rows = [(0,)] * 1000 + [(i % 700 + 1,) for i in range(2000)]
    leaked, sizes = folds_of(spark.createDataFrame(rows, "BENE_ID long"), 3)
    assert leaked == 0
    assert sorted(sizes.values())[0] >= 980 and max(sizes.values()) <= 1020


def test_group_kfold_when_one_key_is_more_than_a_fold(spark):
    rows = [(0,)] * 1500 + [(i % 300 + 1,) for i in range(600)]
    leaked, sizes = folds_of(spark.createDataFrame(rows, "BENE_ID long"), 3)
    assert leaked == 0 and sorted(sizes.values())[2] == 1500
    assert abs(sorted(sizes.values())[0] - 300) <= 10


def test_stratified_split_takes_the_share_of_every_class(modeling):
    rows = modeling.select(*TEXTS, S.TIER)
    folded = splits.stratified_split(rows, S.TIER, texts())
    total = dict(map(tuple, rows.groupBy(S.TIER).count().collect()))
    train = dict(map(tuple, folded.filter("fold = 'train'").groupBy(S.TIER).count().collect()))
    assert {t: math.ceil(0.7 * n) for t, n in total.items()} == train


def test_quantile_groups_are_even(modeling):
    sizes = splits.quantile_groups(modeling, S.TOTAL).groupBy("quantile_group").count().collect()
    assert len(sizes) == 5 and all(abs(r["count"] - 60) <= 2 for r in sizes)


def test_sample_is_repeatable_and_capped(modeling):
    rows = modeling.select(*TEXTS)
    a = splits.sample_rows(rows, texts(), 20).collect()
    b = splits.sample_rows(rows.repartition(5), texts(), 20).collect()
    assert len(a) == 20 and sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert splits.sample_rows(rows, texts(), 10_000).count() == rows.count()
    assert sorted(map(tuple, splits.sample_rows(rows, texts(), 20, seed=1).collect())) != sorted(map(tuple, a))
