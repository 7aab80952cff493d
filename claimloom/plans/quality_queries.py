"""Queries over constraints, column profiles and splits."""

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import profile, quality, rollup, splits
from claimloom.plans.registry import query
from claimloom.plans.sql import FOLDS, MERGED, MODELING, RAW


def _counts(rules: list[tuple[str, str]], source: str) -> str:
    parts = [
        f"SELECT '{name}' AS rule, CAST(count(*) FILTER (WHERE {broken}) AS BIGINT) AS rows FROM {source}"
        for name, broken in rules
    ]
    return " UNION ALL ".join(parts)


_CODE = "regexp_matches({c}, '^[0-9A-Z]{{3,7}}$')"
_CLAIM_RULES = [
    ("BENE_ID:not_null", "BENE_ID IS NULL"),
    ("PRNCPAL_DGNS_CD_inp:not_null", "PRNCPAL_DGNS_CD_inp IS NULL"),
    ("PRNCPAL_DGNS_CD_inp:matches", "NOT " + _CODE.format(c="PRNCPAL_DGNS_CD_inp")),
    ("PRNCPAL_DGNS_CD_out:not_null", "PRNCPAL_DGNS_CD_out IS NULL"),
    ("PRNCPAL_DGNS_CD_out:matches", "NOT " + _CODE.format(c="PRNCPAL_DGNS_CD_out")),
    ("CLM_E_POA_IND_SW1:not_null", "CLM_E_POA_IND_SW1 IS NULL"),
    ("CLM_E_POA_IND_SW1:is_in", "CLM_E_POA_IND_SW1 NOT IN ('Y','U')"),
    ("PRVDR_STATE_CD_inp:not_null", "PRVDR_STATE_CD_inp IS NULL"),
    ("PRVDR_STATE_CD_inp:in_range", "PRVDR_STATE_CD_inp NOT BETWEEN 1 AND 53"),
    ("PRVDR_STATE_CD_out:not_null", "PRVDR_STATE_CD_out IS NULL"),
    ("PRVDR_STATE_CD_out:in_range", "PRVDR_STATE_CD_out NOT BETWEEN 1 AND 53"),
    ("Number_of_Claims_inp:not_null", "Number_of_Claims_inp IS NULL"),
    ("Number_of_Claims_inp:at_least", "Number_of_Claims_inp < 0"),
    ("Number_of_Claims_out:not_null", "Number_of_Claims_out IS NULL"),
    ("Number_of_Claims_out:at_least", "Number_of_Claims_out < 0"),
    ("CLM_TOT_CHRG_AMT_inp:not_null", "CLM_TOT_CHRG_AMT_inp IS NULL"),
    ("CLM_TOT_CHRG_AMT_inp:above", "CLM_TOT_CHRG_AMT_inp <= 0"),
    ("CLM_TOT_CHRG_AMT_out:not_null", "CLM_TOT_CHRG_AMT_out IS NULL"),
    ("CLM_TOT_CHRG_AMT_out:above", "CLM_TOT_CHRG_AMT_out <= 0"),
    (
        "PRVDR_STATE_CD_inp=PRVDR_STATE_CD_out:agree",
        "PRVDR_STATE_CD_inp IS DISTINCT FROM PRVDR_STATE_CD_out",
    ),
]


@query("constraint_violations", f"WITH {MERGED} {_counts(_CLAIM_RULES, 'claims')}")
def constraint_violations(t):
    return quality.violations(t.claims(), quality.claims_schema().rules).drop("rule_no")


_RAW_RULES = [
    ("PRNCPAL_DGNS_CD:not_null", "PRNCPAL_DGNS_CD IS NULL"),
    ("PRNCPAL_DGNS_CD:matches", "NOT regexp_matches(PRNCPAL_DGNS_CD, '^[A-Z][0-9A-Z]{2,6}$')"),
    ("CLM_E_POA_IND_SW1:not_null", "CLM_E_POA_IND_SW1 IS NULL"),
    ("CLM_E_POA_IND_SW1:is_in", "CLM_E_POA_IND_SW1 NOT IN ('Y')"),
    ("PRVDR_STATE_CD:in_range", "PRVDR_STATE_CD NOT BETWEEN 2 AND 20"),
    ("BENE_ID:at_least", "BENE_ID < 0"),
    ("CLM_TOT_CHRG_AMT:above", "CLM_TOT_CHRG_AMT <= 100"),
]


@query("raw_violations", f"WITH {RAW} {_counts(_RAW_RULES, 'claims_raw')}")
def raw_violations(t):
    rules = [
        quality.not_null("PRNCPAL_DGNS_CD"),
        quality.matches("PRNCPAL_DGNS_CD", S.DIAGNOSIS_PATTERN),
        quality.not_null("CLM_E_POA_IND_SW1"),
        quality.is_in("CLM_E_POA_IND_SW1", ["Y"]),
        quality.in_range("PRVDR_STATE_CD", 2, 20),
        quality.at_least("BENE_ID", 0),
        quality.above("CLM_TOT_CHRG_AMT", 100),
    ]
    return quality.violations(t.raw(), rules).drop("rule_no")


_MODEL_RULES = [
    ("TOTAL_CHARGE:not_null", "TOTAL_CHARGE IS NULL"),
    ("TOTAL_CHARGE:above", "TOTAL_CHARGE <= 0"),
    ("LOG_TOTAL_CHARGE:not_null", "LOG_TOTAL_CHARGE IS NULL"),
    ("TC_class:not_null", "TC_class IS NULL"),
    ("TC_class:is_in", "TC_class NOT IN (1,2,3,4,5)"),
    ("Median_Income:not_null", "Median_Income IS NULL"),
    ("Median_Income:above", "Median_Income <= 0"),
]


@query("modeling_violations", f"WITH {MODELING} {_counts(_MODEL_RULES, 'modeling')}")
def modeling_violations(t):
    return quality.violations(t.modeling(), quality.modeling_schema().rules).drop("rule_no")


# Scoring input: raw outpatient codes and flags as a caller may send them.
_SCORING_SQL = f"""WITH {RAW}, requests AS (
  SELECT CLM_ID, BENE_ID, CASE WHEN CLM_ID % 11 = 0 THEN '' ELSE PRNCPAL_DGNS_CD END AS code,
    CASE WHEN CLM_ID % 7 = 0 THEN 'X' ELSE CLM_E_POA_IND_SW1 END AS poa,
    PRVDR_STATE_CD - 2 AS n_inp, CAST(CLM_TOT_CHRG_AMT - 100 AS DOUBLE) AS income FROM inp),
checked AS (SELECT *, concat_ws('; ',
    CASE WHEN code IS NULL THEN 'PRNCPAL_DGNS_CD_inp is null' END,
    CASE WHEN length(code) < 1 THEN 'PRNCPAL_DGNS_CD_inp is shorter than 1' END,
    CASE WHEN code IS NULL THEN 'PRNCPAL_DGNS_CD_out is null' END,
    CASE WHEN length(code) < 1 THEN 'PRNCPAL_DGNS_CD_out is shorter than 1' END,
    CASE WHEN poa IS NULL THEN 'CLM_E_POA_IND_SW1 is null' END,
    CASE WHEN poa NOT IN ('Y','U') THEN 'CLM_E_POA_IND_SW1 is not one of [''Y'', ''U'']' END,
    CASE WHEN n_inp < 0 THEN 'Number_of_Claims_inp is below 0' END,
    CASE WHEN n_inp < 0 THEN 'Number_of_Claims_out is below 0' END,
    CASE WHEN income <= 0 THEN 'Median_Income is not above 0' END) AS errors FROM requests)
"""


def _requests(t):
    rows = rollup.prepare(t.raw_inpatient(), 1)
    code = F.when(F.col("CLM_ID") % 11 == 0, F.lit("")).otherwise(F.col("PRNCPAL_DGNS_CD"))
    flag = F.when(F.col("CLM_ID") % 7 == 0, F.lit("X")).otherwise(F.col(S.FLAG_COLUMN))
    return rows.select(
        "CLM_ID",
        "BENE_ID",
        code.alias(S.CODE_COLUMNS[0]),
        code.alias(S.CODE_COLUMNS[1]),
        flag.alias(S.FLAG_COLUMN),
        (F.col("PRVDR_STATE_CD") - 2).alias("Number_of_Claims_inp"),
        (F.col("PRVDR_STATE_CD") - 2).alias("Number_of_Claims_out"),
        (F.col("CLM_TOT_CHRG_AMT") - 100).cast("double").alias(S.INCOME),
    )


@query(
    "quarantine_rows",
    f"{_SCORING_SQL} SELECT CLM_ID, BENE_ID, errors FROM checked WHERE errors <> ''",
)
def quarantine_rows(t):
    bad = quality.quarantine(_requests(t), quality.scoring_rules())
    return bad.select("CLM_ID", "BENE_ID", F.array_join("errors", "; ").alias("errors"))


@query(
    "accepted_rows",
    f"{_SCORING_SQL} SELECT CLM_ID, BENE_ID, code, poa, income FROM checked WHERE errors = ''",
)
def accepted_rows(t):
    good = quality.accepted(_requests(t), quality.scoring_rules())
    return good.select(
        "CLM_ID", "BENE_ID", F.col(S.CODE_COLUMNS[0]).alias("code"),
        F.col(S.FLAG_COLUMN).alias("poa"), F.col(S.INCOME).alias("income"),
    )


@query(
    "unique_violations",
    f"WITH {RAW} SELECT CLM_ID, count(*) AS rows FROM claims_raw GROUP BY 1 HAVING count(*) > 1",
)
def unique_violations(t):
    return quality.repeated_values(t.raw(), "CLM_ID")


@query(
    "states_agree",
    f"""WITH {MERGED} SELECT 'PRVDR_STATE_CD_inp=PRVDR_STATE_CD_out:agree' AS rule,
      count(*) FILTER (WHERE PRVDR_STATE_CD_inp IS DISTINCT FROM PRVDR_STATE_CD_out) AS rows FROM claims""",
)
def states_agree(t):
    return quality.violations(
        t.claims(), [quality.columns_agree(S.STATE_INP, S.STATE_OUT)]
    ).drop("rule_no")


@query(
    "procedure_code_report",
    f"""WITH {MERGED}, pairs AS (
      SELECT 'PRNCPAL_DGNS_CD_inp' AS column_name, PRNCPAL_DGNS_CD_inp AS code FROM claims
      UNION ALL SELECT 'PRNCPAL_DGNS_CD_out', PRNCPAL_DGNS_CD_out FROM claims)
    SELECT column_name, code, count(*) AS rows FROM pairs
    WHERE regexp_matches(code, '^[0-9A-Z]{{3,7}}$') AND NOT regexp_matches(code, '^[A-Z][0-9A-Z]{{2,6}}$')
    GROUP BY 1, 2""",
)
def procedure_code_report(t):
    return quality.procedure_codes(t.claims())


@query(
    "coerced_types",
    """SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
      TRY_CAST(p_name AS DOUBLE) AS name_no, TRY_CAST(p_name AS DOUBLE) IS NULL AS name_lost FROM part""",
)
def coerced_types(t):
    text = t.read("part").select(
        "p_partkey", F.expr("substr(p_brand, 7)").alias("brand_no"), F.col("p_name").alias("name_no")
    )
    cast, rules = quality.coerce(text, {"brand_no": "int", "name_no": "double"})
    return cast.select("p_partkey", "brand_no", "name_no", rules[1].broken.alias("name_lost"))


@query(
    "null_counts",
    f"""WITH {RAW} """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM claims_raw"
        for c in ["BENE_ID", "CLM_ID", "PRVDR_STATE_CD", "PRNCPAL_DGNS_CD", "CLM_E_POA_IND_SW1",
                  "CLM_TOT_CHRG_AMT", "PATIENT_TYPE"]
    ),
)
def null_counts(t):
    return profile.null_counts(t.raw())


_SUMMARY = ["Number_of_Claims_inp", "Number_of_Claims_out", "TOTAL_CHARGE", "LOG_TOTAL_CHARGE",
            "Median_Income"]


@query(
    "numeric_summary",
    f"""WITH {MODELING}, long AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM modeling" for c in _SUMMARY)})
    SELECT column_name, count(value) AS rows, round(avg(value), 4) AS mean,
      round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(max(value), 4) AS max,
      round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50,
      round(quantile_cont(value, 0.75), 4) AS q75
    FROM long GROUP BY 1""",
)
def numeric_summary(t):
    summary = profile.numeric_summary(t.modeling(), _SUMMARY)
    numbers = ["mean", "std", "min", "max", "q25", "q50", "q75"]
    return summary.select("column_name", "rows", *[F.round(c, 4).alias(c) for c in numbers])


@query(
    "value_counts",
    f"WITH {RAW} SELECT PRNCPAL_DGNS_CD, count(*) AS rows FROM claims_raw GROUP BY 1",
)
def value_counts(t):
    return profile.value_counts(t.raw(), "PRNCPAL_DGNS_CD")


@query("distinct_values", f"WITH {RAW} SELECT DISTINCT CLM_E_POA_IND_SW1 FROM claims_raw")
def distinct_values(t):
    return profile.distinct_values(t.raw(), "CLM_E_POA_IND_SW1")


@query(
    "distinct_keys",
    f"WITH {MERGED} SELECT count(DISTINCT BENE_ID) AS distinct_values FROM claims",
)
def distinct_keys(t):
    return profile.distinct_count(t.claims(), S.GROUP_KEY)


@query(
    "distinct_rows",
    f"""WITH {RAW} SELECT DISTINCT BENE_ID, PRNCPAL_DGNS_CD, CLM_E_POA_IND_SW1, PRVDR_STATE_CD
    FROM claims_raw""",
)
def distinct_rows(t):
    return profile.distinct_rows(
        t.raw().select("BENE_ID", "PRNCPAL_DGNS_CD", "CLM_E_POA_IND_SW1", "PRVDR_STATE_CD")
    )


def _histogram_sql(column: str, low: float, width: float) -> str:
    return f"""WITH {MODELING}, binned AS (
      SELECT CAST(floor(({column} - {low}) / {width}) AS BIGINT) AS bin FROM modeling)
    SELECT bin, count(*) AS rows, {low} + bin * CAST({width} AS DOUBLE) AS bin_start FROM binned GROUP BY 1"""


@query("charge_histogram", _histogram_sql("TOTAL_CHARGE", "0.0", "50000.0"))
def charge_histogram(t):
    return profile.histogram(t.modeling(), S.TOTAL, 0.0, 50000.0)


@query("log_charge_histogram", _histogram_sql("LOG_TOTAL_CHARGE", "0.0", "0.5"))
def log_charge_histogram(t):
    return profile.histogram(t.modeling(), S.LOG_TOTAL, 0.0, 0.5)


@query(
    "freq_inverted_index",
    f"""WITH {MERGED}, long AS (
      SELECT 'PRNCPAL_DGNS_CD_inp' AS column_name, PRNCPAL_DGNS_CD_inp AS code FROM claims
      UNION ALL SELECT 'PRNCPAL_DGNS_CD_out', PRNCPAL_DGNS_CD_out FROM claims)
    SELECT column_name, code, count(*) AS frequency FROM long WHERE code IS NOT NULL GROUP BY 1, 2""",
)
def freq_inverted_index(t):
    return profile.codes_by_frequency(t.claims(), S.CODE_COLUMNS)


@query(
    "group_multiplicity",
    f"""WITH {MERGED}, n AS (SELECT count(*) AS rows FROM claims GROUP BY BENE_ID)
    SELECT count(*) AS keys, round(avg(rows), 6) AS mean_rows, min(rows) AS min_rows,
      max(rows) AS max_rows FROM n""",
)
def group_multiplicity(t):
    return profile.group_multiplicity(t.claims(), S.GROUP_KEY).withColumn(
        "mean_rows", F.round("mean_rows", 6)
    )


@query(
    "scaler_statistics",
    f"""WITH {FOLDS}, long AS (
      SELECT 'Number_of_Claims_inp' AS column_name, CAST(Number_of_Claims_inp AS DOUBLE) AS v FROM train
      UNION ALL SELECT 'Number_of_Claims_out', CAST(Number_of_Claims_out AS DOUBLE) FROM train
      UNION ALL SELECT 'Median_Income', Median_Income FROM train)
    SELECT column_name, round(avg(v), 6) AS mean,
      round(CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END, 6) AS scale FROM long GROUP BY 1""",
)
def scaler_statistics(t):
    train, _ = t.train_test()
    return profile.scaler_statistics(train, S.NUMERIC_COLUMNS).select(
        "column_name", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale")
    )


@query("group_split", f"WITH {FOLDS} SELECT BENE_ID, fold, count(*) AS rows FROM folds GROUP BY 1, 2")
def group_split(t):
    folds = splits.group_split(t.model_rows())
    return folds.groupBy("BENE_ID", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "group_kfold",
    f"""WITH RECURSIVE {MODELING},
    counts AS (SELECT BENE_ID, count(*) AS w, md5(concat(CAST(BENE_ID AS VARCHAR), ':42')) AS h
               FROM model_rows GROUP BY 1),
    grand AS (SELECT sum(w) AS total FROM counts),
    heavy AS (SELECT BENE_ID, w, row_number() OVER (ORDER BY w DESC, BENE_ID) AS i
              FROM counts, grand WHERE w > total / 100.0),
    pack(i, bene, fold, loads) AS (
      SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER),
        [0::DOUBLE, 0::DOUBLE, 0::DOUBLE]
      UNION ALL
      SELECT h.i, h.BENE_ID, CAST(list_position(loads, list_min(loads)) - 1 AS INTEGER),
        list_transform(loads, lambda x, j: CASE WHEN j = list_position(loads, list_min(loads))
                                                THEN x + CAST(h.w AS DOUBLE) ELSE x END)
      FROM pack p JOIN heavy h ON h.i = p.i + 1),
    state AS (SELECT loads FROM pack ORDER BY i DESC LIMIT 1),
    light AS (SELECT BENE_ID, w, h, sum(w) OVER (ORDER BY h) AS upto FROM counts, grand
              WHERE w <= total / 100.0),
    sorted AS (SELECT loads, list_sort(loads) AS s, CAST((SELECT total FROM grand) AS DOUBLE) AS total FROM state),
    level AS (SELECT loads, CASE WHEN s[3] <= total / 3 THEN total / 3
      WHEN s[2] <= (total - s[3]) / 2 THEN (total - s[3]) / 2 ELSE total - s[3] - s[2] END AS lvl FROM sorted),
    targets AS (SELECT ceil(greatest(lvl - loads[1], 0)) AS t1,
      ceil(greatest(lvl - loads[1], 0) + greatest(lvl - loads[2], 0)) AS t2 FROM level)
    SELECT BENE_ID, w AS rows, CASE WHEN upto - w < t1 THEN 0 WHEN upto - w < t2 THEN 1 ELSE 2 END AS fold
    FROM light, targets
    UNION ALL SELECT h.BENE_ID, h.w, p.fold FROM pack p JOIN heavy h ON p.i = h.i""",
)
def group_kfold(t):
    folds = splits.group_kfold(t.model_rows())
    return folds.groupBy("BENE_ID", "fold").agg(F.count(F.lit(1)).alias("rows"))


def row_texts():
    """Texts identifying a model row."""
    return [
        F.col(c).cast("string")
        for c in ["BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out"]
    ]


_ROW_HASH = """md5(concat(concat_ws('|', CAST(BENE_ID AS VARCHAR), PRNCPAL_DGNS_CD_inp,
  CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out, '1'), ':42'))"""
_CONTENT_HASH = _ROW_HASH.replace(", '1'", "")


@query(
    "naive_split_leak",
    f"""WITH {MODELING}, hashed AS (SELECT BENE_ID, {_ROW_HASH} AS h FROM model_rows),
    naive AS (SELECT BENE_ID, CASE WHEN row_number() OVER (ORDER BY h) <= ceil(0.3 * count(*) OVER ())
                                   THEN 'test' ELSE 'train' END AS fold FROM hashed)
    SELECT BENE_ID, min(fold) AS first_fold, max(fold) AS last_fold FROM naive GROUP BY 1
    HAVING min(fold) <> max(fold)""",
)
def naive_split_leak(t):
    return splits.shared_keys(splits.naive_split(t.model_rows(), row_texts()))


@query(
    "fold_overlap",
    f"""WITH {FOLDS} SELECT BENE_ID, min(fold) AS first_fold, max(fold) AS last_fold FROM folds
    GROUP BY 1 HAVING min(fold) <> max(fold)""",
)
def fold_overlap(t):
    return splits.shared_keys(t.folds())


@query(
    "stratified_split",
    f"""WITH {MODELING}, hashed AS (SELECT *, {_ROW_HASH} AS h FROM model_rows)
    SELECT BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out, TC_class,
      CASE WHEN row_number() OVER (PARTITION BY TC_class ORDER BY h)
                <= ceil(0.7 * count(*) OVER (PARTITION BY TC_class)) THEN 'train' ELSE 'test' END AS fold
    FROM hashed""",
)
def stratified_split(t):
    folds = splits.stratified_split(t.model_rows(), S.TIER, row_texts())
    return folds.select("BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out",
                        S.TIER, "fold")


@query(
    "stratified_numeric_split",
    f"""WITH {MODELING}, edges AS (SELECT quantile_cont(TOTAL_CHARGE, 0.2) AS q1,
        quantile_cont(TOTAL_CHARGE, 0.4) AS q2, quantile_cont(TOTAL_CHARGE, 0.6) AS q3,
        quantile_cont(TOTAL_CHARGE, 0.8) AS q4 FROM model_rows),
    grouped AS (SELECT *, {_ROW_HASH} AS h, CASE WHEN TOTAL_CHARGE <= q1 THEN 1 WHEN TOTAL_CHARGE <= q2
        THEN 2 WHEN TOTAL_CHARGE <= q3 THEN 3 WHEN TOTAL_CHARGE <= q4 THEN 4 ELSE 5 END AS quantile_group
      FROM model_rows, edges)
    SELECT BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out, quantile_group,
      CASE WHEN row_number() OVER (PARTITION BY quantile_group ORDER BY h)
                <= ceil(0.7 * count(*) OVER (PARTITION BY quantile_group)) THEN 'train' ELSE 'test' END AS fold
    FROM grouped""",
)
def stratified_numeric_split(t):
    grouped = splits.quantile_groups(t.model_rows(), S.TOTAL)
    folds = splits.stratified_split(grouped, "quantile_group", row_texts())
    return folds.select("BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out",
                        "quantile_group", "fold")


@query(
    "stratified_sample",
    f"""WITH {MODELING}, sizes AS (SELECT TC_class, count(*) AS n FROM model_rows GROUP BY 1),
    hashed AS (SELECT m.*, n, CAST(concat('0x', substr({_CONTENT_HASH}, 1, 8)) AS BIGINT) / 4294967296.0 AS place
      FROM model_rows m JOIN sizes USING (TC_class))
    SELECT BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out, TC_class
    FROM hashed WHERE place < least(1.0, sqrt(CAST(n AS DOUBLE)) * 10 / n)""",
)
def stratified_sample(t):
    """About ten times the root of each tier's size."""
    rows = t.model_rows()
    sizes = rows.groupBy(S.TIER).agg(F.count(F.lit(1)).alias("n"))
    fraction = F.least(F.lit(1.0), F.sqrt("n") * 10 / F.col("n"))
    sample = splits.sample_by(rows, S.TIER, sizes.select(S.TIER, fraction.alias("fraction")), row_texts())
    return sample.select("BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out", S.TIER)


@query(
    "background_sample",
    f"""WITH {FOLDS}, hashed AS (SELECT *, md5(concat(concat_ws('|', CAST(BENE_ID AS VARCHAR),
        PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out), ':42')) AS h FROM train)
    SELECT PRNCPAL_DGNS_CD_inp, PRNCPAL_DGNS_CD_out, CLM_E_POA_IND_SW1, Number_of_Claims_inp,
      Number_of_Claims_out, Median_Income FROM hashed ORDER BY h LIMIT 200""",
)
def background_sample(t):
    train, _ = t.train_test()
    return splits.sample_rows(train, row_texts()).select(*S.FEATURES)
