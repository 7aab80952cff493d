"""Each rule rejects a table with one corrupted cell and accepts the clean one."""

import pytest
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import quality
from tests.conftest import claim_rows, claims_frame

CORRUPT = {
    "poa": (2, "X", "CLM_E_POA_IND_SW1"),
    "code": (1, "!!bad", "PRNCPAL_DGNS_CD_inp"),
    "state": (3, 999, "PRVDR_STATE_CD_inp"),
    "charge": (5, "-1.0", "CLM_TOT_CHRG_AMT_inp"),
    "count": (4, -3, "Number_of_Claims_inp"),
    "null key": (0, None, "BENE_ID"),
}


def test_clean_claims_pass(claims):
    assert quality.validate_claims(claims).count() == claims.count()


@pytest.mark.parametrize("name", CORRUPT)
def test_one_corrupted_cell_is_rejected(spark, name):
    place, value, column = CORRUPT[name]
    rows = claim_rows(50)
    rows[17] = (*rows[17][:place], value, *rows[17][place + 1 :])
    with pytest.raises(quality.SchemaError, match=column):
        quality.validate_claims(claims_frame(spark, rows))


def test_disagreeing_states_are_rejected(claims):
    moved = claims.withColumn(S.STATE_OUT, F.col(S.STATE_OUT) % 51 + 1)
    with pytest.raises(quality.SchemaError, match="disagree"):
        quality.validate_claims(moved)


def test_text_that_is_no_number_is_rejected(claims):
    text = claims.withColumn("Number_of_Claims_inp", F.lit("many"))
    with pytest.raises(quality.SchemaError, match="Number_of_Claims_inp is not"):
        quality.validate_claims(text)
    numbers = claims.withColumn("Number_of_Claims_inp", F.lit("3")).withColumn("extra", F.lit(1))
    checked = quality.validate_claims(numbers)
    assert dict(checked.dtypes)["Number_of_Claims_inp"] == "bigint" and "extra" in checked.columns


def test_missing_column_is_named(claims):
    with pytest.raises(quality.SchemaError, match="missing column BENE_ID"):
        quality.validate_claims(claims.drop("BENE_ID"))


def test_income_states_are_unique(income):
    assert quality.validate_income(income).count() == 53
    with pytest.raises(quality.SchemaError, match="repeats"):
        quality.validate_income(income.unionByName(income.limit(1)))


def test_modeling_rows_need_income(modeling):
    assert quality.validate_modeling_frame(modeling).count() == modeling.count()
    lost = modeling.withColumn(S.INCOME, F.when(F.col("BENE_ID") != 3, F.col(S.INCOME)))
    with pytest.raises(quality.SchemaError, match="Median_Income is null"):
        quality.validate_modeling_frame(lost)


def test_covid_code_passes_and_procedure_code_is_reported(claims):
    code = F.when(F.col("BENE_ID") == 1, F.lit("0FB43ZZ")).otherwise(F.lit("U071"))
    odd = claims.withColumn("PRNCPAL_DGNS_CD_out", code)
    assert quality.validate_claims(odd).count() == claims.count()
    found = quality.procedure_codes(odd).collect()
    assert [(r.column_name, r.code) for r in found] == [("PRNCPAL_DGNS_CD_out", "0FB43ZZ")]
    assert quality.procedure_codes(claims).count() == 0


def test_scoring_rules_list_every_reason(spark):
    good = ("C440", "ZZZ999", "Y", 4, 9, 39000.0)
    rows = [good, ("C440", "L200", "X", -1, 7, 0.0), (None, "", "Y", 3, 7, 1.0)]
    frame = spark.createDataFrame(rows, S.FEATURE_SCHEMA)
    assert [tuple(r) for r in quality.accepted(frame, quality.scoring_rules()).collect()] == [good]
    reasons = sorted(len(r.errors) for r in quality.quarantine(frame, quality.scoring_rules()).collect())
    assert reasons == [2, 3]


def test_violations_are_counted_in_one_pass(claims):
    counts = quality.violations(claims, quality.claims_schema().rules)
    assert counts.agg(F.sum("rows")).first()[0] == 0
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1
