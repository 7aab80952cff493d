"""The drift job: features and predictions of a batch against the training fold."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.storage import as_table
from claimloom.operators import drift, splits
from claimloom.operators.scoring import Bundle
from claimloom.sources import tables

PREDICTION = "predicted_tier"


def comparison(
    spark: SparkSession, modeling: DataFrame, current: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(reference, current)`` features: the training fold against a batch file.

    Without a file the held-out fold is the batch.
    """
    train, test = splits.split_by_beneficiary(modeling)
    batch = tables.load_current(spark, current)
    reference = as_table(clean.feature_frame(train), "reference")
    return reference, as_table(clean.feature_frame(test if batch is None else batch), "current")


def report(
    reference: DataFrame, current: DataFrame, threshold: float = S.DRIFT_THRESHOLD
) -> dict[str, DataFrame]:
    """Statistics of numeric and text columns, one score per column, and the summary."""
    numeric, texts = drift.column_roles(reference)
    scores = drift.column_scores(reference, current, numeric, texts, threshold)
    found = {"column_scores": scores, "summary": drift.summarise(scores)}
    if numeric:
        found["numeric"] = drift.numeric_drift(reference, current, numeric)
    if texts:
        found["categorical"] = drift.categorical_drift(reference, current, texts)
    return found


def predictions(bundle: Bundle, rows: DataFrame) -> DataFrame:
    scored = bundle.classifier.transform(rows)
    return as_table(scored.select(clean.to_tier(F.col("prediction")).alias(PREDICTION)), "predicted")


def run(
    spark: SparkSession,
    modeling: DataFrame,
    bundle: Bundle,
    output: str,
    current: str | None = None,
    kind: str = "parquet",
) -> None:
    """Write feature drift and prediction drift below ``output``."""
    reference, batch = comparison(spark, modeling, current)
    tables.write_report(report(reference, batch), f"{output}/features", kind)
    guessed = report(predictions(bundle, reference), predictions(bundle, batch))
    tables.write_report(guessed, f"{output}/predictions", kind)
