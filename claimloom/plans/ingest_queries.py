"""Queries over raw claims, the merged claims table and its targets."""

import uuid

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.storage import shared_folder
from claimloom.operators import enrich, profile, rollup
from claimloom.plans.registry import query
from claimloom.sources import tables as sources
from claimloom.plans.sql import INCOME, MERGED, MODELING, RAW

CLAIM_OUTPUT = [
    "BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRVDR_STATE_CD_inp",
    "Number_of_Claims_inp", "PRNCPAL_DGNS_CD_out", "PRVDR_STATE_CD_out", "Number_of_Claims_out",
]
CLAIM_SQL = ", ".join(CLAIM_OUTPUT) + """,
  CAST(CLM_TOT_CHRG_AMT_inp AS DOUBLE) AS charge_inp, CAST(CLM_TOT_CHRG_AMT_out AS DOUBLE) AS charge_out"""


def claim_output(frame):
    return frame.select(
        *CLAIM_OUTPUT,
        F.col(S.CHARGE_INP).cast("double").alias("charge_inp"),
        F.col(S.CHARGE_OUT).cast("double").alias("charge_out"),
    )


@query("claims_rollup", f"WITH {MERGED} SELECT {CLAIM_SQL} FROM claims")
def claims_rollup(t):
    return claim_output(rollup.merged_claims(t.raw_inpatient(), t.raw_outpatient()))


@query("claims_table_scan", f"WITH {MERGED} SELECT {CLAIM_SQL} FROM claims")
def claims_table_scan(t):
    return claim_output(t.claims())


def as_csv(t, name, frame):
    """Write ``frame`` as CSV with its columns in reverse order; the reader goes by name."""
    path = f"{shared_folder(t.spark)}/{t.spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}.csv"
    frame.select(*reversed(frame.columns)).write.csv(path, header=True)
    return path


@query("claims_csv_scan", f"WITH {MERGED} SELECT {CLAIM_SQL} FROM claims")
def claims_csv_scan(t):
    """Claims written as CSV, charges as currency texts, and read again by name."""
    marked = t.claims().withColumn(S.CHARGE_INP, F.concat(F.lit("$"), F.format_number(S.CHARGE_INP, 2)))
    return claim_output(sources.load_claims(t.spark, as_csv(t, "claims", marked)))


@query("income_csv_scan", f"WITH {INCOME} SELECT PRVDR_STATE_CD, STATE, Median_Income FROM income")
def income_csv_scan(t):
    return sources.load_income(t.spark, as_csv(t, "income", t.income_text()))


@query(
    "raw_extract_rejects",
    f"""WITH {RAW}, cells AS (
      SELECT CASE WHEN CLM_ID % 97 = 0 THEN 'BENE_ID' WHEN CLM_ID % 89 = 0 THEN 'CLM_TOT_CHRG_AMT'
             ELSE 'none' END AS bad, CLM_TOT_CHRG_AMT FROM inp)
    SELECT bad AS unreadable, count(*) AS rows,
      CASE WHEN bad = 'none' THEN CAST(sum(CLM_TOT_CHRG_AMT) AS DOUBLE) END AS charges
    FROM cells GROUP BY 1""",
)
def raw_extract_rejects(t):
    """A raw extract with bad ids and bad amounts: what is kept, and why rows are rejected."""
    bad_id, bad_amount = F.abs("CLM_ID") % 97 == 0, F.abs("CLM_ID") % 89 == 0
    money = F.concat(F.lit("$"), F.format_number("CLM_TOT_CHRG_AMT", 2))
    extract = t.raw_inpatient().withColumns(
        {
            "BENE_ID": F.when(bad_id, F.lit("n/a")).otherwise(F.col("BENE_ID").cast("string")),
            "CLM_TOT_CHRG_AMT": F.when(bad_amount & ~bad_id, F.lit("twelve")).otherwise(money),
        }
    )
    rejects = f"{shared_folder(t.spark)}/{t.spark.sparkContext.applicationId}/rejects-{uuid.uuid4().hex}"
    kept = sources.load_raw_extract(t.spark, as_csv(t, "extract", extract), rejects)
    reasons = t.spark.read.parquet(rejects).select(F.explode("errors").alias("error"))
    return (
        reasons.groupBy(F.substring_index("error", ":", 1).alias("unreadable"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("charges", F.lit(None).cast("double"))
        .unionByName(
            kept.agg(F.count(F.lit(1)).alias("rows"), F.sum("CLM_TOT_CHRG_AMT").cast("double").alias("charges"))
            .withColumn("unreadable", F.lit("none"))
        )
    )


@query(
    "prepared_ids",
    f"""WITH {RAW}, prepared AS (SELECT * FROM inp UNION ALL SELECT * FROM outp)
    SELECT BENE_ID, CLM_ID, PATIENT_TYPE FROM prepared""",
)
def prepared_ids(t):
    inp, out = rollup.prepare(t.raw_inpatient(), 1), rollup.prepare(t.raw_outpatient(), 0)
    return inp.unionByName(out).select("BENE_ID", "CLM_ID", "PATIENT_TYPE")


@query(
    "complete_rows",
    f"""WITH {RAW} SELECT BENE_ID, CLM_ID, PRVDR_STATE_CD, PRNCPAL_DGNS_CD, CLM_E_POA_IND_SW1,
      CAST(CLM_TOT_CHRG_AMT AS DOUBLE) AS charge FROM inp
    WHERE PRNCPAL_DGNS_CD IS NOT NULL AND CLM_E_POA_IND_SW1 IS NOT NULL
      AND CLM_TOT_CHRG_AMT IS NOT NULL AND PRVDR_STATE_CD IS NOT NULL""",
)
def complete_rows(t):
    kept = clean.drop_incomplete(rollup.prepare(t.raw_inpatient(), 1))
    return kept.select(
        "BENE_ID", "CLM_ID", "PRVDR_STATE_CD", "PRNCPAL_DGNS_CD", "CLM_E_POA_IND_SW1",
        F.col("CLM_TOT_CHRG_AMT").cast("double").alias("charge"),
    )


@query(
    "inpatient_rollup",
    f"""WITH {MERGED} SELECT BENE_ID, PRNCPAL_DGNS_CD_inp AS code, CLM_E_POA_IND_SW1 AS poa,
      PRVDR_STATE_CD_inp AS state, Number_of_Claims_inp AS claims,
      CAST(CLM_TOT_CHRG_AMT_inp AS DOUBLE) AS charge FROM agg_inp""",
)
def inpatient_rollup(t):
    rows = clean.drop_incomplete(rollup.prepare(t.raw_inpatient(), 1))
    return rollup.roll_up(rows, rollup.INPATIENT_KEYS).select(
        "BENE_ID", F.col("PRNCPAL_DGNS_CD").alias("code"), F.col("CLM_E_POA_IND_SW1").alias("poa"),
        F.col("PRVDR_STATE_CD").alias("state"), F.col("Number_of_Claims").alias("claims"),
        F.col("CLM_TOT_CHRG_AMT").cast("double").alias("charge"),
    )


@query(
    "outpatient_rollup",
    f"""WITH {MERGED} SELECT BENE_ID, PRNCPAL_DGNS_CD_out AS code, PRVDR_STATE_CD_out AS state,
      Number_of_Claims_out AS claims, CAST(CLM_TOT_CHRG_AMT_out AS DOUBLE) AS charge FROM agg_out""",
)
def outpatient_rollup(t):
    rows = rollup.prepare(t.raw_outpatient(), 0)
    return rollup.roll_up(rows, rollup.OUTPATIENT_KEYS).select(
        "BENE_ID", F.col("PRNCPAL_DGNS_CD").alias("code"), F.col("PRVDR_STATE_CD").alias("state"),
        F.col("Number_of_Claims").alias("claims"),
        F.col("CLM_TOT_CHRG_AMT").cast("double").alias("charge"),
    )


@query(
    "group_size_window",
    f"""WITH {RAW} SELECT BENE_ID, CLM_ID, PRNCPAL_DGNS_CD AS code,
      count(CLM_TOT_CHRG_AMT) OVER (PARTITION BY BENE_ID, PRNCPAL_DGNS_CD, PRVDR_STATE_CD) AS claims
    FROM outp WHERE PRNCPAL_DGNS_CD IS NOT NULL""",
)
def group_size_window(t):
    rows = rollup.prepare(t.raw_outpatient(), 0).dropna(subset=rollup.OUTPATIENT_KEYS)
    sized = rollup.group_sizes(rows, rollup.OUTPATIENT_KEYS, "CLM_TOT_CHRG_AMT", "claims")
    return sized.select("BENE_ID", "CLM_ID", F.col("PRNCPAL_DGNS_CD").alias("code"), "claims")


@query(
    "semi_join_outpatient",
    f"""WITH {RAW} SELECT BENE_ID, CLM_ID, PRNCPAL_DGNS_CD, CAST(CLM_TOT_CHRG_AMT AS DOUBLE) AS charge
    FROM outp WHERE BENE_ID IN (SELECT BENE_ID FROM inp)""",
)
def semi_join_outpatient(t):
    inp, out = rollup.prepare(t.raw_inpatient(), 1), rollup.prepare(t.raw_outpatient(), 0)
    return rollup.with_inpatient_stay(out, inp).select(
        "BENE_ID", "CLM_ID", "PRNCPAL_DGNS_CD", F.col("CLM_TOT_CHRG_AMT").cast("double").alias("charge")
    )


@query(
    "mn_join",
    f"""WITH {RAW},
    i AS (SELECT BENE_ID, PRNCPAL_DGNS_CD, count(*) AS n FROM inp GROUP BY ALL),
    o AS (SELECT BENE_ID, PRNCPAL_DGNS_CD, count(*) AS n FROM outp GROUP BY ALL)
    SELECT i.BENE_ID, i.PRNCPAL_DGNS_CD AS PRNCPAL_DGNS_CD_inp, i.n AS n_inp,
           o.PRNCPAL_DGNS_CD AS PRNCPAL_DGNS_CD_out, o.n AS n_out FROM i JOIN o USING (BENE_ID)""",
)
def mn_join(t):
    keys = ["BENE_ID", "PRNCPAL_DGNS_CD"]
    i = rollup.prepare(t.raw_inpatient(), 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    o = rollup.prepare(t.raw_outpatient(), 0).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return rollup.merge_sides(i, o)


@query("income_table", f"WITH {INCOME} SELECT * FROM income")
def income_table(t):
    return t.income()


@query(
    "currency_parse",
    f"""WITH {INCOME}, amounts AS (
      SELECT CAST(n_nationkey AS VARCHAR) AS id, Median_Income AS txt FROM income_text
        JOIN nation ON PRVDR_STATE_CD = n_nationkey + 1
      UNION ALL SELECT concat('p', CAST(p_partkey AS VARCHAR)),
        CASE WHEN p_partkey % 4 = 0 THEN concat('$', CAST(p_size AS VARCHAR), ',', '000 ')
             WHEN p_partkey % 4 = 1 THEN concat(CAST(p_size AS VARCHAR), chr(160))
             WHEN p_partkey % 4 = 2 THEN ' ' ELSE p_name END FROM part)
    SELECT id, TRY_CAST(replace(replace(replace(replace(txt,'$',''),',',''),' ',''),chr(160),'')
             AS DOUBLE) AS amount FROM amounts""",
)
def currency_parse(t):
    income = t.income_text().select(
        (F.col(S.STATE_KEY) - 1).cast("string").alias("id"), F.col(S.INCOME).alias("txt")
    )
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    parts = t.read("part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(kind == 0, F.concat(F.lit("$"), size, F.lit(",000 ")))
        .when(kind == 1, F.concat(size, F.lit("\u00a0")))
        .when(kind == 2, F.lit(" "))
        .otherwise(F.col("p_name"))
        .alias("txt"),
    )
    return income.unionByName(parts).select("id", clean.parse_currency("txt").alias("amount"))


@query(
    "income_left_join",
    f"WITH {MODELING} SELECT {CLAIM_SQL}, STATE, Median_Income FROM enriched",
)
def income_left_join(t):
    joined = enrich.merge_income(t.claims(), t.income())
    return joined.select(*claim_output(joined).columns[:-2],
                         F.col(S.CHARGE_INP).cast("double").alias("charge_inp"),
                         F.col(S.CHARGE_OUT).cast("double").alias("charge_out"),
                         "STATE", S.INCOME)


@query(
    "unmatched_states",
    f"""WITH {MODELING} SELECT PRVDR_STATE_CD_inp, count(*) AS rows FROM enriched
    WHERE Median_Income IS NULL GROUP BY 1""",
)
def unmatched_states(t):
    return enrich.unmatched_keys(t.claims(), t.income(), S.STATE_INP, S.STATE_KEY)


@query(
    "targets_and_tiers",
    f"""WITH {MODELING} SELECT BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out,
      TOTAL_CHARGE, round(LOG_TOTAL_CHARGE, 6) AS log_charge, TC_class FROM modeling""",
)
def targets_and_tiers(t):
    return t.modeling().select(
        "BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out",
        S.TOTAL, F.round(S.LOG_TOTAL, 6).alias("log_charge"), S.TIER,
    )


@query(
    "tier_distribution",
    f"""WITH {MODELING} SELECT TC_class, count(*) AS rows,
      round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM modeling), 6) AS share
    FROM modeling GROUP BY 1""",
)
def tier_distribution(t):
    return profile.distribution(t.modeling(), S.TIER)


@query(
    "tier_cut_edges",
    f"""WITH edges AS (SELECT o_orderkey, CAST(round(o_totalprice / 1000) * 1000 AS DOUBLE) AS charge FROM orders)
    SELECT o_orderkey, charge, CASE WHEN charge <= 1000 THEN 1 WHEN charge <= 10000 THEN 2
      WHEN charge <= 100000 THEN 3 WHEN charge <= 1000000 THEN 4 ELSE 5 END AS tier FROM edges""",
)
def tier_cut_edges(t):
    charge = F.round(F.col("o_totalprice") / 1000) * 1000
    orders = t.read("orders").select("o_orderkey", charge.cast("double").alias("charge"))
    return orders.withColumn("tier", clean.tier_of(F.col("charge")))


@query(
    "tier_actions",
    f"""WITH {MODELING} SELECT TC_class, CASE TC_class
      WHEN 1 THEN 'Under $1K - routine, auto-approval candidate'
      WHEN 2 THEN '$1K-$10K - standard processing'
      WHEN 3 THEN '$10K-$100K - elevated cost, sample for review'
      WHEN 4 THEN '$100K-$1M - high cost, route to utilization review'
      ELSE 'Over $1M - catastrophic claim, specialist handling' END AS description,
      count(*) AS rows FROM modeling GROUP BY 1, 2""",
)
def tier_actions(t):
    described = t.modeling().withColumn("description", clean.tier_description(F.col(S.TIER)))
    return described.groupBy(S.TIER, "description").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "normalised_codes",
    """SELECT doc_id, upper(trim(concat(' ', source, lang, '  '))) AS code FROM documents""",
)
def normalised_codes(t):
    typed = F.concat(F.lit(" "), F.col("source"), F.col("lang"), F.lit("  "))
    return t.read("documents").select("doc_id", clean.normalise_code(typed).alias("code"))


@query(
    "label_round_trip",
    f"""WITH {MODELING} SELECT TC_class, CAST(TC_class - 1 AS DOUBLE) AS label, TC_class AS restored,
      count(*) AS rows FROM modeling GROUP BY 1, 2, 3""",
)
def label_round_trip(t):
    labelled = t.modeling().withColumn("label", clean.to_zero_based(F.col(S.TIER)))
    return (
        labelled.withColumn("restored", clean.to_tier(F.col("label")))
        .groupBy(S.TIER, "label", "restored")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "back_transform",
    f"""WITH {MODELING} SELECT BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out,
      round(exp(LOG_TOTAL_CHARGE), 4) AS dollars FROM modeling""",
)
def back_transform(t):
    return t.modeling().select(
        "BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out",
        F.round(clean.to_dollars(F.col(S.LOG_TOTAL)), 4).alias("dollars"),
    )


@query(
    "preview_rows",
    f"""WITH {MERGED} SELECT {CLAIM_SQL} FROM claims
    ORDER BY BENE_ID, PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1, PRNCPAL_DGNS_CD_out LIMIT 10""",
)
def preview_rows(t):
    order = ["BENE_ID", "PRNCPAL_DGNS_CD_inp", "CLM_E_POA_IND_SW1", "PRNCPAL_DGNS_CD_out"]
    return claim_output(clean.preview(t.claims(), order, 10))


@query(
    "procedure_flags",
    f"""WITH {RAW} SELECT PRNCPAL_DGNS_CD AS code,
      regexp_matches(PRNCPAL_DGNS_CD, '^[0-9A-Z]{{3,7}}$')
        AND NOT regexp_matches(PRNCPAL_DGNS_CD, '^[A-Z][0-9A-Z]{{2,6}}$') AS is_procedure,
      count(*) AS rows FROM claims_raw WHERE PRNCPAL_DGNS_CD IS NOT NULL GROUP BY 1, 2""",
)
def procedure_flags(t):
    coded = t.raw().filter("PRNCPAL_DGNS_CD IS NOT NULL")
    return (
        coded.groupBy(F.col("PRNCPAL_DGNS_CD").alias("code"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("is_procedure", clean.is_procedure_code(F.col("code")))
    )


@query(
    "feature_frame",
    f"""WITH {MODELING} SELECT PRNCPAL_DGNS_CD_inp, PRNCPAL_DGNS_CD_out, CLM_E_POA_IND_SW1,
      Number_of_Claims_inp, Number_of_Claims_out, Median_Income FROM model_rows""",
)
def feature_frame(t):
    return clean.feature_frame(t.model_rows())
