"""Roll raw inpatient and outpatient claims up into the merged claims table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.skew import fan_out_join, lookup_join
from claimloom.operators.dropped import DropReport, observed

CHARGE = "CLM_TOT_CHRG_AMT"
INPATIENT_KEYS = ["BENE_ID", "PRNCPAL_DGNS_CD", "CLM_E_POA_IND_SW1", "PRVDR_STATE_CD"]
OUTPATIENT_KEYS = ["BENE_ID", "PRNCPAL_DGNS_CD", "PRVDR_STATE_CD"]


def prepare(raw: DataFrame, patient_type: int) -> DataFrame:
    """Non-negative ids, the listed columns and the patient-type flag."""
    kept = clean.keep_listed(raw, S.RAW_COLUMNS)
    ids = [c for c in ("BENE_ID", "CLM_ID") if c in kept.columns]
    return clean.absolute_ids(kept, ids).withColumn("PATIENT_TYPE", F.lit(patient_type))


def with_inpatient_stay(outpatient: DataFrame, inpatient: DataFrame) -> DataFrame:
    """Outpatient rows of people who also have inpatient rows."""
    people = inpatient.select(S.GROUP_KEY).distinct()
    return lookup_join(outpatient, people, [S.GROUP_KEY], "left_semi")


def group_sizes(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Attach to each row the count of non-null ``value`` in its group."""
    sizes = rows.groupBy(*keys).agg(F.count(value).alias(name))
    return lookup_join(rows, sizes, keys, "inner")


def roll_up(rows: DataFrame, keys: Sequence[str], charge: str = CHARGE) -> DataFrame:
    """Charge sum and claim count per group; groups with a null key are dropped.

    The claim count is constant inside a group, so grouping by it as well would
    give the same rows: one aggregation serves for both.
    """
    complete = rows.dropna("any", subset=list(keys))
    total = F.coalesce(F.sum(charge), F.lit(0)).cast("decimal(18,2)")
    return complete.groupBy(*keys).agg(
        F.count(charge).alias("Number_of_Claims"), total.alias(charge)
    )


def suffixed(frame: DataFrame, suffix: str, names: Sequence[str]) -> DataFrame:
    return frame.withColumnsRenamed({c: c + suffix for c in names if c in frame.columns})


def merge_sides(inpatient: DataFrame, outpatient: DataFrame, key: str = S.GROUP_KEY) -> DataFrame:
    """Many-to-many join of both roll-ups; shared names get a side suffix."""
    shared = [c for c in inpatient.columns if c in outpatient.columns and c != key]
    return fan_out_join(
        suffixed(inpatient, "_inp", shared), suffixed(outpatient, "_out", shared), key
    )


def rolled_up(inpatient: DataFrame, outpatient: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both prepared sides as groups, the inpatient one without incomplete rows."""
    complete = clean.drop_incomplete(inpatient)
    return roll_up(complete, INPATIENT_KEYS), roll_up(outpatient, OUTPATIENT_KEYS)


def merged_claims(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """The merged claims table from raw extracts.

    Both sides shrink to their groups before they meet. The inner join already
    drops people without a stay, so no separate semi join is needed here.
    """
    return _merged(prepare(inpatient, 1), prepare(outpatient, 0))


def merged_with_report(inpatient: DataFrame, outpatient: DataFrame) -> tuple[DataFrame, DropReport]:
    """The merged claims table, and the inpatient rows lost to nulls, known once the table has been written.

    The rows are counted before a shuffle: see :func:`observed`.
    """
    watched, report = observed(prepare(inpatient, 1))
    return _merged(watched, prepare(outpatient, 0)), report


def _merged(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    return merge_sides(*rolled_up(inpatient, outpatient)).select(*S.CLAIMS_SCHEMA.fieldNames())
