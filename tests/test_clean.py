"""Cleaning, tiers and the small scalar derivations."""

import math

import pytest
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean


def values(spark, texts, column):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_currency_texts(spark):
    texts = ["60510", "$60,510 ", "$1,234", "$60,510 ", "", "nan", None, "n/a", " 7 ", "1\t000"]
    assert values(spark, texts, clean.parse_currency("t")) == [
        60510.0, 60510.0, 1234.0, 60510.0, None, None, None, None, 7.0, 1000.0,
    ]


def test_tier_upper_edges_belong_to_their_tier(spark):
    charges = ["0.01", "1000", "1000.01", "10000", "100000", "1000000", "1000000.01", None]
    tier = clean.tier_of(F.col("t").cast("decimal(18,2)"))
    assert values(spark, charges, tier) == [1, 1, 2, 2, 3, 4, 5, None]


def test_targets(modeling):
    row = modeling.first()
    total = float(row[S.CHARGE_INP] + row[S.CHARGE_OUT])
    assert row[S.TOTAL] == pytest.approx(total)
    assert row[S.LOG_TOTAL] == pytest.approx(math.log(total))


def test_labels_round_trip(spark):
    frame = spark.createDataFrame([(t,) for t in S.TIERS], "t int")
    label = clean.to_zero_based(F.col("t"))
    rows = frame.select(label.alias("l"), clean.to_tier(label).alias("b"), "t").collect()
    assert sorted(r.l for r in rows) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert all(r.b == r.t for r in rows)


def test_procedure_codes_are_not_diagnoses(spark):
    codes = ["I10", "U071", "0FB43ZZ", "!!bad", "i10", "AB", None]
    assert values(spark, codes, clean.is_procedure_code(F.col("t"))) == [
        False, False, True, False, False, False, None,
    ]


def test_keep_listed_keeps_table_order(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "CLM_ID int, other int, BENE_ID int")
    assert clean.keep_listed(frame, S.RAW_COLUMNS).columns == ["CLM_ID", "BENE_ID"]


def test_codes_are_trimmed_and_upper_case(spark):
    assert values(spark, [" i10 "], clean.normalise_code("t")) == ["I10"]
