"""Model queries: fitted on the whole training fold, answered on the whole test fold.

Every query fits its own model, of the full ``Sizes``.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.operators import attribution, candidates, drift, scoring, splits, tuning
from claimloom.operators.encoders import FEATURE_VECTOR, build_preprocessor, feature_names
from claimloom.plans import least_squares, training
from claimloom.plans.quality_queries import row_texts
from claimloom.plans.registry import query
from claimloom.plans.sql import FOLDS, SCORES


def _encoded(t) -> tuple[training.Encoded, DataFrame, DataFrame]:
    train, test = training.split(t.model_rows())
    return training.encode(train, test), train, test


def _classifier(name: str):
    return candidates.classifiers()[name]


def _tier_query(query_name: str, name: str):
    @query(query_name)
    def build(t):
        """Confusion counts of the held-out fold."""
        data, _, _ = _encoded(t)
        model, _ = data.fit(_classifier(name))
        guess = clean.to_tier(F.col("prediction")).alias("predicted_tier")
        return model.transform(data.test).groupBy(
            clean.to_tier(F.col("label")).alias("tier"), guess
        ).agg(F.count(F.lit(1)).alias("rows"))


_ROW = f"BENE_ID, {', '.join(S.CODE_COLUMNS)}, {S.FLAG_COLUMN}"


def _charge_query(query_name: str, name: str, sql: str | None = None):
    @query(query_name, sql)
    def build(t):
        """Predicted charge of every held-out row."""
        data, _, test = _encoded(t)
        _, pipeline = data.fit(candidates.fitting_regressors(data.train)[name])
        return pipeline.transform(test).select(
            "BENE_ID", *S.CODE_COLUMNS, S.FLAG_COLUMN, F.round(S.LOG_TOTAL, 6).alias(S.LOG_TOTAL),
            F.round("prediction", 4).alias("predicted_log"),
        )


def _least_squares(penalty: float) -> str:
    return f"""WITH {least_squares.predictions(penalty)} SELECT {_ROW},
      round(LOG_TOTAL_CHARGE, 6) AS LOG_TOTAL_CHARGE, round(p, 4) AS predicted_log FROM predicted"""


for _query, _model in (
    ("knn_tier", "knn"),
    ("tree_tier", "decision_tree"),
    ("forest_tier", "random_forest"),
    ("boosted_tier", "boosted_trees"),
):
    _tier_query(_query, _model)

for _query, _model, _sql in (
    ("linear_charge", "linear_regression", _least_squares(0.0)),
    ("ridge_charge", "ridge_regression", _least_squares(1.0)),
    ("forest_charge", "random_forest_regressor", None),
    ("boosted_charge", "boosted_regressor", None),
):
    _charge_query(_query, _model, _sql)


@query("tuned_params")
def tuned_params(t):
    train, _ = training.split(t.model_rows())
    found = tuning.tune_classifier("random_forest", train)
    rows = [
        (i, k, str(v), tried["score"]) for i, tried in enumerate(found.tried)
        for k, v in tried["settings"].items()
    ]
    return t.spark.createDataFrame(rows, "setting_no int, setting string, value string, cv_macro_f1 double")


@query("feature_importance")
def feature_importance(t):
    data, _, _ = _encoded(t)
    _, pipeline = data.fit(_classifier("random_forest"))
    return candidates.feature_importance(pipeline)


def _bundle(t, classifier: str | None = None, regressor: str | None = None, background: bool = False) -> tuple:
    """The asked models, fitted on the training fold, and the rows to score."""
    data, train, test = _encoded(t)
    tier = data.fit(_classifier(classifier))[1] if classifier else None
    charge = data.fit(candidates.fitting_regressors(data.train)[regressor])[1] if regressor else None
    sample = splits.sample_rows(train, row_texts()).select(*S.FEATURES) if background else None
    names = {"classifier": classifier, "regressor": regressor}
    return scoring.Bundle(tier, charge, names, sample), test.select("BENE_ID", *S.FEATURES)


@query("score_tier")
def score_tier(t):
    bundle, rows = _bundle(t, classifier="decision_tree")
    return scoring.predict_tier(bundle, rows, explain=False).drop("top_contributions")


@query(
    "score_charge",
    f"""WITH {least_squares.predictions()} SELECT BENE_ID, {', '.join(S.FEATURES)},
      round(p, 4) AS predicted_log_charge, 1.0::DOUBLE AS dollars_per_exp, 'linear_regression' AS model_name
    FROM predicted""",
)
def score_charge(t):
    bundle, rows = _bundle(t, regressor="linear_regression")
    scored = scoring.predict_charge(bundle, rows)
    # Dollars have too many digits to compare; they are the log's exponential.
    per_exp = F.col("predicted_charge") / F.exp("predicted_log_charge")
    return scored.select(
        "BENE_ID", *S.FEATURES, F.round("predicted_log_charge", 4).alias("predicted_log_charge"),
        F.round(per_exp, 6).alias("dollars_per_exp"), "model_name",
    )


@query("shapley_exact")
def shapley_exact(t):
    bundle, rows = _bundle(t, classifier="decision_tree", background=True)
    scored = scoring.predict_tier(bundle, rows)
    return scored.select("BENE_ID", *S.FEATURES, "tier", F.posexplode("top_contributions").alias("rank", "c")).select(
        "BENE_ID", *S.FEATURES, "tier", "rank", "c.feature", "c.contribution", "c.direction"
    )


@query("prediction_drift")
def prediction_drift(t):
    data, _, _ = _encoded(t)
    model, _ = data.fit(_classifier("decision_tree"))
    tier = clean.to_tier(F.col("prediction")).alias("predicted_tier")
    reference, current = (model.transform(rows).select(tier) for rows in (data.train, data.test))
    numeric = drift.numeric_drift(reference, current, ["predicted_tier"])
    return numeric.join(drift.categorical_drift(reference, current, ["predicted_tier"]), "column_name")


@query(
    "explode_probabilities",
    f"""WITH {SCORES}, long AS ({" UNION ALL ".join(
        f"SELECT BENE_ID, 'Tier {i}' AS tier, p{i} AS probability FROM scores" for i in S.TIERS)})
    SELECT * FROM long""",
)
def explode_probabilities(t):
    labels = F.array(*[F.lit(str(i)) for i in S.TIERS])
    shares = F.map_from_arrays(labels, F.array(*[F.col(f"p{i}") for i in S.TIERS]))
    scored = t.rule_scores().select("BENE_ID", shares.alias("probabilities"))
    return attribution.probability_table(scored, "BENE_ID")


_MEANS = [
    ("PRNCPAL_DGNS_CD_inp_freq", "avg(a.n / CAST(x.total AS DOUBLE))"),
    ("PRNCPAL_DGNS_CD_out_freq", "avg(b.n / CAST(x.total AS DOUBLE))"),
    ("CLM_E_POA_IND_SW1_U", "avg(CASE WHEN x.CLM_E_POA_IND_SW1 = 'U' THEN 1.0 ELSE 0.0 END)"),
    ("CLM_E_POA_IND_SW1_Y", "avg(CASE WHEN x.CLM_E_POA_IND_SW1 = 'Y' THEN 1.0 ELSE 0.0 END)"),
    ("Number_of_Claims_inp", "0.0"),
    ("Number_of_Claims_out", "0.0"),
    ("Median_Income", "0.0"),
]


@query(
    "feature_means",
    f"""WITH {FOLDS}, f1 AS (SELECT PRNCPAL_DGNS_CD_inp AS v, count(*) AS n FROM train GROUP BY 1),
    f2 AS (SELECT PRNCPAL_DGNS_CD_out AS v, count(*) AS n FROM train GROUP BY 1),
    sized AS (SELECT *, count(*) OVER () AS total FROM train),
    x AS (SELECT {", ".join(f"{e} AS m{i}" for i, (_, e) in enumerate(_MEANS))}
      FROM sized x JOIN f1 a ON a.v = x.PRNCPAL_DGNS_CD_inp JOIN f2 b ON b.v = x.PRNCPAL_DGNS_CD_out)
    {" UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS feature, round(CAST(m{i} AS DOUBLE), 6) AS mean FROM x"
        for i, (n, _) in enumerate(_MEANS))}""",
)
def feature_means(t):
    """Mean of every assembled feature over the training fold, by its name."""
    train, _ = t.train_test()
    fitted = build_preprocessor().fit(train)
    x = vector_to_array(FEATURE_VECTOR)
    names = feature_names(fitted)
    means = fitted.transform(train).agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(len(names))])
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature"),
                     F.abs(F.round(f"m{i}", 6)).alias("mean"))
            for i, n in enumerate(names)
        ]
    )
    return means.select(F.inline(pairs))
