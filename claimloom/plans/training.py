"""The training job: validate, split, tune, fit, compare and export."""

import logging
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.storage import as_table
from claimloom.operators import enrich, metrics, quality, splits
from claimloom.operators.candidates import (
    LABEL,
    WEIGHT,
    Sizes,
    classifiers,
    feature_importance,
    fitting_regressors,
)
from claimloom.operators.dropped import DropReport, observed
from claimloom.operators.encoders import FEATURE_VECTOR, build_preprocessor, with_class_weights
from claimloom.operators.tuning import SEARCH_SPACES, Tuned, tune_classifier
from claimloom.sources import bundles, runs

logger = logging.getLogger(__name__)

TIER_RULE = f"{S.MACRO_F1_WEIGHT}*macro_f1 + {S.ACCURACY_WEIGHT}*accuracy"
CHARGE_RULE = "lowest rmse_log"


@dataclass
class Fitted:
    """A fitted candidate with its held-out metrics."""

    model: PipelineModel
    metrics: dict[str, float]
    settings: dict[str, str]
    confusion: DataFrame | None = None


def settings_of(model: Estimator) -> dict[str, str]:
    """All settings of a model, given or default, without the names of its columns."""
    found = {p.name: model.getOrDefault(p) for p in model.params if model.isDefined(p)}
    return {k: str(v) for k, v in sorted(found.items()) if not k.endswith("Col")}


def ingest_and_validate(claims: DataFrame, income: DataFrame) -> DataFrame:
    """Validated modeling rows; procedure codes are reported, not rejected."""
    checked = quality.validate_claims(claims)
    lookup = quality.validate_income(income)
    found = quality.procedure_codes(checked).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("codes"), F.sum("rows").alias("rows")
    )
    for row in found.collect():
        logger.warning("%s: %s procedure codes in %s rows", row.column_name, row.codes, row.rows)
    return quality.validate_modeling_frame(enrich.modeling_frame(checked, lookup))


def split(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled train and test tables sharing no person."""
    return split_with_report(frame)[:2]


def split_with_report(frame: DataFrame) -> tuple[DataFrame, DataFrame, DropReport]:
    """The two tables, and the nulls per column with the rows that keeping complete rows alone would lose."""
    watched, report = observed(splits.group_split(frame), frame.columns)
    folds = as_table(watched, "folds", split=True)
    splits.require_disjoint(folds)
    labelled = folds.withColumn(LABEL, clean.to_zero_based(F.col(S.TIER)))
    train = labelled.filter("fold = 'train'").drop("fold")
    labels = [float(i) for i in range(len(S.TIERS))]
    weighted = with_class_weights(train, LABEL, labels, WEIGHT)
    return weighted, labelled.filter("fold = 'test'").drop("fold"), report


def tune(
    train: DataFrame, n_iter: int = 10, spaces: dict | None = None, sizes: Sizes = Sizes(), store: str | None = None
) -> dict[str, Tuned]:
    """Best settings of the two ensembles; the baselines are not tuned. Trials are kept under ``store``."""
    return {
        name: tune_classifier(name, train, n_iter, space=space, sizes=sizes, store=store)
        for name, space in (spaces or SEARCH_SPACES).items()
    }


def tier_scores() -> dict[float, str]:
    return {float(i): f"__p{i}" for i in range(len(S.TIERS))}


def evaluate_classifier(model: Model, test: DataFrame) -> tuple[dict[str, float], DataFrame]:
    """Held-out metrics and confusion matrix; the AUC is left out when a tier is absent from the test fold."""
    scores = tier_scores()
    shares = vector_to_array("probability")
    scored = as_table(
        model.transform(test).select(
            LABEL, "prediction", *[F.get(shares, F.lit(i)).alias(n) for i, n in enumerate(scores.values())]
        ),
        "scored",
    )
    result = metrics.classification_metrics(scored).first().asDict()
    area = metrics.roc_auc_ovr(scored, scores).first()
    if area is not None:
        result["roc_auc_ovr"] = area["roc_auc_ovr"]
    tiers = scored.select(*[clean.to_tier(F.col(c)).alias(n) for c, n in ((LABEL, "label"), ("prediction", "prediction"))])
    return result, metrics.confusion_matrix(tiers, S.TIERS)


def evaluate_regressor(model: Model, test: DataFrame) -> dict[str, float]:
    scored = as_table(model.transform(test).select(S.LOG_TOTAL, "prediction"), "scored")
    return metrics.regression_metrics(scored, S.LOG_TOTAL).first().asDict()


@dataclass
class Encoded:
    """Both folds with assembled features, and the encoders fitted on the first."""

    encoder: PipelineModel
    train: DataFrame
    test: DataFrame

    def fit(self, model: Estimator) -> tuple[Model, PipelineModel]:
        """The fitted model, alone and behind its encoders as one saved object."""
        fitted = model.fit(self.train)
        return fitted, PipelineModel(stages=[self.encoder, fitted])


def encode(train: DataFrame, test: DataFrame) -> Encoded:
    """Fit the encoders once and store the features for all candidates.

    Every candidate would fit the same encoders on the same fold, and tree models
    read their input many times.
    """
    encoder = build_preprocessor().fit(train)
    kept = [LABEL, S.LOG_TOTAL, FEATURE_VECTOR]
    return Encoded(
        encoder,
        as_table(encoder.transform(train).select(*kept, WEIGHT), "train", split=True),
        as_table(encoder.transform(test).select(*kept), "test", split=True),
    )


def train_classifiers(
    data: Encoded, tuned: dict[str, Tuned] | None = None, sizes: Sizes = Sizes(), store: str | None = None
) -> dict[str, Fitted]:
    """Fit every classifier and score it on the held-out fold. Boosted trees are kept under ``store`` on the way."""
    results = {}
    for name, model in classifiers(sizes).items():
        if tuned and name in tuned:
            model = model.copy({model.getParam(k): v for k, v in tuned[name].settings.items()})
        if store and model.hasParam("store"):
            model = model.copy({model.getParam("store"): store})
        fitted, pipeline = data.fit(model)
        values, confusion = evaluate_classifier(fitted, data.test)
        results[name] = Fitted(pipeline, values, settings_of(model), confusion)
        logger.info("%s %s", name, results[name].metrics)
    return results


def train_regressors(data: Encoded, sizes: Sizes = Sizes()) -> dict[str, Fitted]:
    """Fit every regressor and score it on the held-out fold."""
    results = {}
    for name, model in fitting_regressors(data.train, sizes).items():
        fitted, pipeline = data.fit(model)
        results[name] = Fitted(pipeline, evaluate_regressor(fitted, data.test), settings_of(model))
        logger.info("%s %s", name, results[name].metrics)
    return results


def best_model(spark: SparkSession, results: dict[str, Fitted], metric: str, lowest: bool = False) -> str:
    """The candidate with the best metric; the first listed wins ties."""
    rows = [(i, name, float(f.metrics[metric])) for i, (name, f) in enumerate(results.items())]
    board = spark.createDataFrame(rows, f"ordinal int, model string, {metric} double")
    return metrics.select_best(board, metric, lowest).first()["model"]


def confusion_tables(tiers: dict[str, Fitted]) -> DataFrame:
    """Confusion matrix of every classifier: a row per model and true tier."""
    tables = [f.confusion.select(F.lit(name).alias("model"), "*") for name, f in tiers.items()]
    return reduce(DataFrame.unionByName, tables)


def importance_tables(results: dict[str, Fitted]) -> DataFrame | None:
    """Feature importances of every candidate that has them."""
    found = ((name, feature_importance(f.model)) for name, f in results.items())
    tables = [t.select(F.lit(name).alias("model"), "*") for name, t in found if t is not None]
    return reduce(DataFrame.unionByName, tables) if tables else None


def metric_rows(task: str, results: dict[str, Fitted]) -> list[tuple]:
    return [
        (task, name, metric, float(value))
        for name, fitted in results.items()
        for metric, value in fitted.metrics.items()
        if value is not None
    ]


def export(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    tiers: dict[str, Fitted],
    charges: dict[str, Fitted],
    tuned: dict[str, Tuned],
    path: str,
) -> None:
    """Save the winners, a background sample and the metadata tables."""
    tier = best_model(spark, tiers, "selection_score")
    charge = best_model(spark, charges, "rmse_log", lowest=True)
    bundles.save_models(tiers[tier].model, charges[charge].model, path)
    texts = [F.col(c).cast("string") for c in (S.GROUP_KEY, *S.FEATURES)]
    bundles.save_background(splits.sample_rows(train, texts).select(*S.FEATURES), path)
    fold_rows = [
        (name, *rows.agg(F.count(F.lit(1)), F.count_distinct(S.GROUP_KEY)).first())
        for name, rows in (("train", train), ("test", test))
    ]
    described = [(t, S.TIER_DESCRIPTIONS[t]) for t in S.TIERS]
    settings = [
        (name, k, str(v), t.score) for name, t in tuned.items() for k, v in t.settings.items()
    ]
    importance = importance_tables({**tiers, **charges})
    bundles.save_metadata(
        {
            "confusion": confusion_tables(tiers),
            **({"importance": importance} if importance is not None else {}),
            "winners": spark.createDataFrame(
                [("tier", tier, TIER_RULE), ("charge", charge, CHARGE_RULE)],
                "task string, model string, selection_rule string",
            ),
            "metrics": spark.createDataFrame(
                metric_rows("tier", tiers) + metric_rows("charge", charges),
                "task string, model string, metric string, value double",
            ),
            "tuning": spark.createDataFrame(
                settings, "model string, setting string, value string, cv_macro_f1 double"
            ),
            "tiers": spark.createDataFrame(described, "tier int, description string"),
            "features": spark.createDataFrame(
                list(enumerate(S.FEATURES)), "position int, feature string"
            ),
            "folds": spark.createDataFrame(fold_rows, "fold string, rows long, keys long"),
        },
        path,
    )


def run(
    spark: SparkSession,
    claims: DataFrame,
    income: DataFrame,
    path: str,
    sizes: Sizes = Sizes(),
    spaces: dict | None = None,
    n_iter: int = 10,
) -> None:
    """The whole training run; results and the run log go below ``path``.

    So do tuning trials and boosted trees while the run goes on: one that was stopped and is started again
    with the same data and path does not repeat them.
    """
    run_id = uuid.uuid4().hex
    train, test, report = split_with_report(ingest_and_validate(claims, income))
    bundles.save_metadata({"nulls": report.table(spark)}, path)
    tuned = tune(train, n_iter, spaces, sizes, f"{path}/trials")
    data = encode(train, test)
    tiers = train_classifiers(data, tuned, sizes, f"{path}/trees")
    charges = train_regressors(data, sizes)
    log = []
    for name, found in tuned.items():
        params = {**found.settings, "cv": "grouped folds by person", "scoring": "macro_f1"}
        log += runs.run_rows(run_id, "hyperparameter_search", name, params, {"cv_macro_f1": found.score})
    for task, results in (("tier_classification", tiers), ("log_charge_regression", charges)):
        for name, fitted in results.items():
            values = {k: v for k, v in fitted.metrics.items() if v is not None}
            log += runs.run_rows(run_id, task, name, {"split": "by person", **fitted.settings}, values)
    runs.append_runs(spark, log, f"{path}/runs")
    export(spark, train, test, tiers, charges, tuned, path)
