"""Parameters of the claims configuration.

Operators take these as arguments, so another table only needs other values.
"""

from pyspark.sql import types as T

# Column names of the claims domain.
GROUP_KEY = "BENE_ID"
STATE_KEY = "PRVDR_STATE_CD"
STATE_INP = "PRVDR_STATE_CD_inp"
STATE_OUT = "PRVDR_STATE_CD_out"
CHARGE_INP = "CLM_TOT_CHRG_AMT_inp"
CHARGE_OUT = "CLM_TOT_CHRG_AMT_out"
INCOME = "Median_Income"
TOTAL = "TOTAL_CHARGE"
LOG_TOTAL = "LOG_TOTAL_CHARGE"
TIER = "TC_class"
CODE_COLUMNS = ["PRNCPAL_DGNS_CD_inp", "PRNCPAL_DGNS_CD_out"]
FLAG_COLUMN = "CLM_E_POA_IND_SW1"
NUMERIC_COLUMNS = ["Number_of_Claims_inp", "Number_of_Claims_out", "Median_Income"]
FEATURES = [*CODE_COLUMNS, FLAG_COLUMN, *NUMERIC_COLUMNS]

# Raw extract columns that are kept.
RAW_COLUMNS = [
    "BENE_ID",
    "CLM_ID",
    "PRVDR_STATE_CD",
    "PRVDR_NUM",
    "PRNCPAL_DGNS_CD",
    "CLM_TOT_CHRG_AMT",
    "CLM_E_POA_IND_SW1",
]

# Cost tiers. An upper edge belongs to its own tier.
TIER_EDGES = [1_000, 10_000, 100_000, 1_000_000]
TIERS = [1, 2, 3, 4, 5]
TIER_DESCRIPTIONS = {
    1: "Under $1K - routine, auto-approval candidate",
    2: "$1K-$10K - standard processing",
    3: "$10K-$100K - elevated cost, sample for review",
    4: "$100K-$1M - high cost, route to utilization review",
    5: "Over $1M - catastrophic claim, specialist handling",
}

# Code formats and allowed ranges.
CODE_PATTERN = "^[0-9A-Z]{3,7}$"
DIAGNOSIS_PATTERN = "^[A-Z][0-9A-Z]{2,6}$"
FLAG_VALUES = ["Y", "U"]
STATE_RANGE = (1, 53)

# Split, sampling and selection parameters.
SEED = 42
TEST_SHARE = 0.3
BACKGROUND_ROWS = 200
TOP_FEATURES = 5
MACRO_F1_WEIGHT = 0.6
ACCURACY_WEIGHT = 0.4
DRIFT_THRESHOLD = 0.1

CLAIMS_SCHEMA = T.StructType(
    [
        T.StructField("BENE_ID", T.LongType()),
        T.StructField("PRNCPAL_DGNS_CD_inp", T.StringType()),
        T.StructField("CLM_E_POA_IND_SW1", T.StringType()),
        T.StructField("PRVDR_STATE_CD_inp", T.IntegerType()),
        T.StructField("Number_of_Claims_inp", T.LongType()),
        T.StructField("CLM_TOT_CHRG_AMT_inp", T.DecimalType(18, 2)),
        T.StructField("PRNCPAL_DGNS_CD_out", T.StringType()),
        T.StructField("PRVDR_STATE_CD_out", T.IntegerType()),
        T.StructField("Number_of_Claims_out", T.LongType()),
        T.StructField("CLM_TOT_CHRG_AMT_out", T.DecimalType(18, 2)),
    ]
)

# The income column arrives as text because some cells carry currency marks.
INCOME_SCHEMA = T.StructType(
    [
        T.StructField("PRVDR_STATE_CD", T.IntegerType()),
        T.StructField("STATE", T.StringType()),
        T.StructField("Median_Income", T.StringType()),
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("BENE_ID", T.LongType()),
        T.StructField("CLM_ID", T.LongType()),
        T.StructField("PRVDR_STATE_CD", T.IntegerType()),
        T.StructField("PRVDR_NUM", T.StringType()),
        T.StructField("PRNCPAL_DGNS_CD", T.StringType()),
        T.StructField("CLM_TOT_CHRG_AMT", T.DecimalType(18, 2)),
        T.StructField("CLM_E_POA_IND_SW1", T.StringType()),
    ]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("PRNCPAL_DGNS_CD_inp", T.StringType()),
        T.StructField("PRNCPAL_DGNS_CD_out", T.StringType()),
        T.StructField("CLM_E_POA_IND_SW1", T.StringType()),
        T.StructField("Number_of_Claims_inp", T.LongType()),
        T.StructField("Number_of_Claims_out", T.LongType()),
        T.StructField("Median_Income", T.DoubleType()),
    ]
)
