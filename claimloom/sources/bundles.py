"""Saving and loading fitted models with their metadata."""

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.scoring import Bundle
from claimloom.sources.tables import load_background, write_background

CLASSIFIER, REGRESSOR, BACKGROUND = "tier_classifier", "charge_regressor", "background"


def save_models(classifier: PipelineModel, regressor: PipelineModel, path: str) -> None:
    """Write both pipelines, replacing earlier ones."""
    classifier.write().overwrite().save(f"{path}/{CLASSIFIER}")
    regressor.write().overwrite().save(f"{path}/{REGRESSOR}")


def save_metadata(tables: dict[str, DataFrame], path: str) -> None:
    """Write the metadata tables (winners, metrics, tuning, folds ...) as JSON."""
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").json(f"{path}/metadata/{name}")


def save_background(sample: DataFrame, path: str) -> None:
    write_background(sample, f"{path}/{BACKGROUND}")


def load_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.json(f"{path}/metadata/{name}")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """Load both models, the winners' names and the background sample if there is one.

    Raises ``FileNotFoundError`` when no model was exported to ``path``.
    """
    for folder in (CLASSIFIER, REGRESSOR):
        try:
            spark.read.text(f"{path}/{folder}/metadata").limit(1).collect()
        except AnalysisException as error:
            raise FileNotFoundError(f"No exported model at {path}/{folder}") from error
    winners = {r.task: r.model for r in load_table(spark, path, "winners").collect()}
    return Bundle(
        PipelineModel.load(f"{path}/{CLASSIFIER}"),
        PipelineModel.load(f"{path}/{REGRESSOR}"),
        {"classifier": winners["tier"], "regressor": winners["charge"]},
        load_background(spark, f"{path}/{BACKGROUND}"),
    )


def model_info(spark: SparkSession, path: str) -> DataFrame:
    """Winners with their selection rule and held-out metrics, as rows."""
    winners, metrics = load_table(spark, path, "winners"), load_table(spark, path, "metrics")
    return winners.join(F.broadcast(metrics), ["task", "model"]).select(
        "task", "model", "selection_rule", "metric", "value"
    )
