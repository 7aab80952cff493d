"""Shared session and a small seeded claims table."""

import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimloom import settings as S  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("claimloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PEOPLE, CODES_PER_SIDE = 45, 50


def claim_rows(n=300, seed=7):
    """Rows of the merged claims table. Codes are drawn unevenly, and charges grow with the code's number."""
    draw = random.Random(seed)

    def side(letters):
        number = min(int(draw.expovariate(0.08)), CODES_PER_SIDE - 1)
        code = f"{letters[number % len(letters)]}{10 + number}{number % 7}"
        return code, draw.randint(1, 12), f"{20 * (number + 1) ** 2 * draw.uniform(0.5, 9):.2f}"

    rows = []
    for _ in range(n):
        state = draw.randint(1, 53)
        (inp, inp_claims, inp_charge), (out, out_claims, out_charge) = side("BDG"), side("HNRS")
        rows.append(
            (draw.randint(1, PEOPLE), inp, "Y" if draw.random() < 0.6 else "U", state, inp_claims, inp_charge,
             out, state, out_claims, out_charge)
        )
    return rows


def claims_frame(spark, rows):
    names = S.CLAIMS_SCHEMA.fieldNames()
    kinds = ", ".join(
        f"{f.name} {'string' if f.name.startswith('CLM_TOT') else f.dataType.simpleString()}"
        for f in S.CLAIMS_SCHEMA
    )
    frame = spark.createDataFrame(rows, kinds)
    return frame.select(*[frame[c].cast(S.CLAIMS_SCHEMA[c].dataType).alias(c) for c in names])


@pytest.fixture(scope="session")
def claims(spark):
    return claims_frame(spark, claim_rows()).cache()


@pytest.fixture(scope="session")
def income(spark):
    return spark.createDataFrame(
        [(i, f"S{i}", 50_000.0 + 100 * i) for i in range(1, 54)],
        "PRVDR_STATE_CD int, STATE string, Median_Income double",
    )


@pytest.fixture(scope="session")
def modeling(spark, claims, income):
    from claimloom.operators import enrich

    return enrich.modeling_frame(claims, income).cache()
