"""Run log: parameters and metrics of training and tuning runs."""

from pyspark.sql import DataFrame, SparkSession

RUN_SCHEMA = "run string, task string, model string, kind string, key string, value string"


def run_rows(run: str, task: str, model: str, params: dict, metrics: dict) -> list[tuple]:
    """Log entries of one fitted model."""
    return [
        *[(run, task, model, "param", str(k), str(v)) for k, v in params.items()],
        *[(run, task, model, "metric", str(k), repr(float(v))) for k, v in metrics.items()],
    ]


def append_runs(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Append entries to the run table; a few per fitted model."""
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)
