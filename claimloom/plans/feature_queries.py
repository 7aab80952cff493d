"""Queries over encoders, leak audits and class weights."""

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.operators import encoders, profile
from claimloom.plans.registry import query
from claimloom.plans.sql import FOLDS

INP, OUT = S.CODE_COLUMNS


def _map_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS rows, "
        f"count(*) / CAST((SELECT count({c}) FROM {source}) AS DOUBLE) AS frequency "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in (INP, OUT)
    )


@query(
    "frequency_map",
    f"""WITH {FOLDS}, f AS ({_map_sql('train')})
    SELECT column_name, value, rows, round(frequency, 9) AS frequency FROM f""",
)
def frequency_map(t):
    train, _ = t.train_test()
    return profile.frequency_table(train, S.CODE_COLUMNS).withColumn(
        "frequency", F.round("frequency", 9)
    )


@query(
    "frequency_counts",
    f"""WITH {FOLDS}, f AS ({_map_sql('folds')})
    SELECT column_name, value, rows, CAST(rows AS DOUBLE) AS frequency FROM f""",
)
def frequency_counts(t):
    return profile.frequency_table(t.folds(), S.CODE_COLUMNS, normalize=False)


@query(
    "frequency_encode",
    f"""WITH {FOLDS}, f AS ({_map_sql('train')}),
    least AS (SELECT column_name, min(frequency) AS lo FROM f GROUP BY 1)
    SELECT x.BENE_ID, x.{INP}, x.CLM_E_POA_IND_SW1, x.{OUT},
      round(coalesce(a.frequency, (SELECT lo FROM least WHERE column_name='{INP}')), 9) AS inp_freq,
      round(coalesce(b.frequency, (SELECT lo FROM least WHERE column_name='{OUT}')), 9) AS out_freq
    FROM folds x LEFT JOIN f a ON a.column_name='{INP}' AND a.value = x.{INP}
                 LEFT JOIN f b ON b.column_name='{OUT}' AND b.value = x.{OUT}""",
)
def frequency_encode(t):
    folds = t.folds()
    train = folds.filter("fold = 'train'")
    model = encoders.FrequencyEncoder(inputCols=S.CODE_COLUMNS).fit(train)
    return model.transform(folds).select(
        "BENE_ID", INP, S.FLAG_COLUMN, OUT,
        F.round(f"{INP}_freq", 9).alias("inp_freq"), F.round(f"{OUT}_freq", 9).alias("out_freq"),
    )


@query(
    "one_hot_poa",
    f"""WITH {FOLDS} SELECT BENE_ID, {INP}, CLM_E_POA_IND_SW1, {OUT},
      CASE WHEN CLM_E_POA_IND_SW1 = 'U' THEN 1 ELSE 0 END AS CLM_E_POA_IND_SW1_U,
      CASE WHEN CLM_E_POA_IND_SW1 = 'Y' THEN 1 ELSE 0 END AS CLM_E_POA_IND_SW1_Y FROM model_rows""",
)
def one_hot_poa(t):
    hot = encoders.one_hot(t.model_rows(), S.FLAG_COLUMN, ["U", "Y"])
    return hot.select("BENE_ID", INP, S.FLAG_COLUMN, OUT, "CLM_E_POA_IND_SW1_U", "CLM_E_POA_IND_SW1_Y")


@query(
    "standardise",
    f"""WITH {FOLDS}, s AS (SELECT avg(Number_of_Claims_inp) AS m1, stddev_pop(Number_of_Claims_inp) AS s1,
      avg(Number_of_Claims_out) AS m2, stddev_pop(Number_of_Claims_out) AS s2,
      avg(Median_Income) AS m3, stddev_pop(Median_Income) AS s3 FROM train)
    SELECT BENE_ID, {INP}, CLM_E_POA_IND_SW1, {OUT},
      round((Number_of_Claims_inp - m1) / s1, 6) AS n_inp, round((Number_of_Claims_out - m2) / s2, 6) AS n_out,
      round((Median_Income - m3) / s3, 6) AS income FROM folds, s""",
)
def standardise(t):
    folds = t.folds()
    scaler = encoders.PopulationScaler(
        inputCols=S.NUMERIC_COLUMNS, outputCols=["n_inp", "n_out", "income"]
    ).fit(folds.filter("fold = 'train'"))
    return scaler.transform(folds).select(
        "BENE_ID", INP, S.FLAG_COLUMN, OUT, *[F.round(c, 6).alias(c) for c in ("n_inp", "n_out", "income")]
    )


@query(
    "preprocessed_features",
    f"""WITH {FOLDS}, f AS ({_map_sql('train')}),
    least AS (SELECT column_name, min(frequency) AS lo FROM f GROUP BY 1),
    s AS (SELECT avg(Number_of_Claims_inp) AS m1, stddev_pop(Number_of_Claims_inp) AS s1,
      avg(Number_of_Claims_out) AS m2, stddev_pop(Number_of_Claims_out) AS s2,
      avg(Median_Income) AS m3, stddev_pop(Median_Income) AS s3 FROM train)
    SELECT x.BENE_ID, x.{INP}, x.{OUT},
      round(coalesce(a.frequency, (SELECT lo FROM least WHERE column_name='{INP}')), 6) AS f0,
      round(coalesce(b.frequency, (SELECT lo FROM least WHERE column_name='{OUT}')), 6) AS f1,
      CASE WHEN CLM_E_POA_IND_SW1 = 'U' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f2,
      CASE WHEN CLM_E_POA_IND_SW1 = 'Y' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f3,
      round((Number_of_Claims_inp - m1) / s1, 6) AS f4, round((Number_of_Claims_out - m2) / s2, 6) AS f5,
      round((Median_Income - m3) / s3, 6) AS f6
    FROM test x CROSS JOIN s LEFT JOIN f a ON a.column_name='{INP}' AND a.value = x.{INP}
                LEFT JOIN f b ON b.column_name='{OUT}' AND b.value = x.{OUT}""",
)
def preprocessed_features(t):
    from pyspark.ml.functions import vector_to_array

    train, test = t.train_test()
    fitted = encoders.build_preprocessor().fit(train)
    vector = vector_to_array(encoders.FEATURE_VECTOR)
    return fitted.transform(test).select(
        "BENE_ID", INP, OUT, *[F.round(vector[i], 6).alias(f"f{i}") for i in range(7)]
    )


def _only_in_test_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS test_rows FROM test "
        f"WHERE {c} NOT IN (SELECT {c} FROM train) GROUP BY 2"
        for c in (INP, OUT)
    )


@query("test_only_codes", f"WITH {FOLDS} {_only_in_test_sql()}")
def test_only_codes(t):
    return encoders.values_only_in_test(t.folds(), S.CODE_COLUMNS)


@query(
    "leaked_codes",
    f"""WITH {FOLDS}, only_test AS ({_only_in_test_sql()}), f AS ({_map_sql('folds')}),
    g AS ({_map_sql('train')})
    SELECT 'all rows' AS fitted_on, o.* FROM only_test o SEMI JOIN f USING (column_name, value)
    UNION ALL SELECT 'train' AS fitted_on, o.* FROM only_test o SEMI JOIN g USING (column_name, value)""",
)
def leaked_codes(t):
    folds = t.folds()
    only_test = encoders.values_only_in_test(folds, S.CODE_COLUMNS)
    parts = [
        encoders.leaked_values(profile.frequency_table(rows, S.CODE_COLUMNS), only_test).withColumn(
            "fitted_on", F.lit(name)
        )
        for name, rows in (("all rows", folds), ("train", folds.filter("fold = 'train'")))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "class_weights",
    f"""WITH {FOLDS}, c AS (SELECT TC_class, count(*) AS n FROM train GROUP BY 1)
    SELECT BENE_ID, {INP}, CLM_E_POA_IND_SW1, {OUT}, TC_class,
      round((SELECT sum(n) / CAST(count(*) AS DOUBLE) FROM c) / c.n, 6) AS weight
    FROM train JOIN c USING (TC_class)""",
)
def class_weights(t):
    train, _ = t.train_test()
    weighted = encoders.with_class_weights(train, S.TIER, S.TIERS)
    return weighted.select("BENE_ID", INP, S.FLAG_COLUMN, OUT, S.TIER, F.round("weight", 6).alias("weight"))


@query(
    "flag_levels",
    f"""WITH {FOLDS} SELECT fold, CLM_E_POA_IND_SW1, count(*) AS rows FROM folds GROUP BY 1, 2""",
)
def flag_levels(t):
    features = clean.feature_frame(t.folds()).columns
    return t.folds().select("fold", *features).groupBy("fold", S.FLAG_COLUMN).agg(
        F.count(F.lit(1)).alias("rows")
    )
