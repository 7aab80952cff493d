"""Encoders learn from the training fold only and cope with the unseen."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import skew
from claimloom.operators import encoders, profile, splits


def freq(rows, column, value):
    return [r[column] for r in rows if r["code"] == value]


def test_frequencies_come_from_training_rows_only(spark):
    train = spark.createDataFrame([("A00",)] * 99 + [("B00",)], "code string")
    test = spark.createDataFrame([("B00",)] * 50 + [("C00",), (None,)], "code string")
    model = encoders.FrequencyEncoder(inputCols=["code"]).fit(train)
    rows = model.transform(test).collect()
    assert len(rows) == 52
    assert set(freq(rows, "code_freq", "B00")) == {0.01}
    assert freq(rows, "code_freq", "C00") == [0.01] and freq(rows, "code_freq", None) == [0.01]
    # The broken twin: fitted on the rows it should not see.
    leaky = encoders.FrequencyEncoder(inputCols=["code"]).fit(train.unionByName(test))
    assert set(freq(leaky.transform(test).collect(), "code_freq", "B00")) != {0.01}


def test_raw_counts(spark):
    train = spark.createDataFrame([("A",)] * 3 + [("B",)] * 2, "code string")
    model = encoders.FrequencyEncoder(inputCols=["code"], outputCols=["n"], normalize=False).fit(train)
    unseen = train.unionByName(spark.createDataFrame([("Z",)], "code string"))
    assert sorted((r.code, r.n) for r in model.transform(unseen).distinct().collect()) == [
        ("A", 3.0), ("B", 2.0), ("Z", 2.0),
    ]


def test_large_maps_are_shuffled_with_equal_results(spark, monkeypatch):
    train = spark.createDataFrame([(f"c{i % 90}",) for i in range(1000)] + [("hot",)] * 500, "code string")
    model = encoders.FrequencyEncoder(inputCols=["code"]).fit(train)
    small = sorted(map(tuple, model.transform(train).collect()))
    monkeypatch.setattr(encoders, "BROADCAST_ROWS", 10)
    assert sorted(map(tuple, model.transform(train).collect())) == small
    assert skew.BROADCAST_ROWS > 10


def test_leak_audit_works_in_both_directions(modeling):
    folds = splits.group_split(modeling)
    only_test = encoders.values_only_in_test(folds, S.CODE_COLUMNS)
    assert only_test.count() > 0
    train = profile.frequency_table(folds.filter("fold = 'train'"), S.CODE_COLUMNS)
    assert encoders.leaked_values(train, only_test).count() == 0
    everything = profile.frequency_table(folds, S.CODE_COLUMNS)
    assert encoders.leaked_values(everything, only_test).count() == only_test.count()


def test_preprocessor_vector(spark, modeling, tmp_path):
    train, test = splits.split_by_beneficiary(modeling)
    fitted = encoders.build_preprocessor().fit(train)
    names = encoders.feature_names(fitted)
    assert names == [
        "PRNCPAL_DGNS_CD_inp_freq", "PRNCPAL_DGNS_CD_out_freq", "CLM_E_POA_IND_SW1_U",
        "CLM_E_POA_IND_SW1_Y", *S.NUMERIC_COLUMNS,
    ]
    matrix = np.array([r.features.toArray() for r in fitted.transform(train).select("features").collect()])
    assert matrix.shape[1] == 7
    assert np.allclose(matrix[:, 4:].mean(axis=0), 0) and np.allclose(matrix[:, 4:].std(axis=0), 1)
    assert np.allclose(matrix[:, 2:4].sum(axis=1), 1) and 0 < matrix[:, 3].mean() < 1
    odd = test.limit(3).withColumn(S.FLAG_COLUMN, F.lit("Q")).withColumn(S.CODE_COLUMNS[0], F.lit("ZZZ999"))
    row = fitted.transform(odd).first().features.toArray()
    least = profile.frequency_table(train, S.CODE_COLUMNS[:1]).agg(F.min("frequency")).first()[0]
    assert list(row[2:4]) == [0, 0] and row[0] == pytest.approx(least)
    fitted.write().overwrite().save(str(tmp_path / "pre"))
    loaded = PipelineModel.load(str(tmp_path / "pre"))
    pick = ["BENE_ID", *S.FEATURES, "features"]
    assert sorted(map(str, loaded.transform(test).select(*pick).collect())) == sorted(
        map(str, fitted.transform(test).select(*pick).collect())
    )


def test_constant_column_is_scaled_by_one(spark):
    frame = spark.createDataFrame([(5.0,)] * 3, "x double")
    model = encoders.PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(frame)
    assert [r.z for r in model.transform(frame).collect()] == [0.0, 0.0, 0.0]


def test_class_weights_have_mean_one_and_favour_the_rare(spark):
    frame = spark.createDataFrame([(0.0,)] * 90 + [(4.0,)] * 10, "label double")
    weighted = encoders.with_class_weights(frame, "label", [0.0, 1.0, 2.0, 3.0, 4.0])
    by = dict(map(tuple, weighted.distinct().collect()))
    assert by[4.0] > by[0.0]
    assert weighted.agg(F.avg("weight")).first()[0] == pytest.approx(1.0)
