"""Shared-folder storage for intermediate tables."""

import math
import tempfile
import uuid

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local run gets its own.

    On a cluster the setting is required: a folder on one machine would be lost
    with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="claimloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """Materialise ``frame`` reliably so that later passes do not recompute it."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def as_table(frame: DataFrame, name: str, split: bool = False) -> DataFrame:
    """Write ``frame`` as Parquet in the shared folder and read it back.

    Unlike a checkpoint the result keeps column pruning and filter pushdown. With
    ``split`` a small table is written again in as many parts as there are cores,
    for steps that compute much per row.
    """
    spark = frame.sparkSession
    table, path = next_table(frame, name)
    if split and table.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        parts = as_table(spread(table), name)
        _delete(spark, path)
        return parts
    return table


def next_table(frame: DataFrame, name: str, last: str | None = None) -> tuple[DataFrame, str]:
    """Store ``frame`` as a table, and delete the one at ``last`` that it was made from; returns its path too.

    For loops, which would otherwise keep the state of every round.
    """
    spark = frame.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    if last:
        _delete(spark, last)
    return spark.read.schema(frame.schema).parquet(path), path


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's tables, removed by :func:`remove_tables`."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    # Spark has no call of its own for this.
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`next_table` that nothing reads any more."""
    _delete(spark, path)


def drop_checkpoint(spark: SparkSession, rdd: RDD | None) -> None:
    """Delete the files of a checkpoint that nothing reads any more."""
    if rdd is not None and rdd.getCheckpointFile():
        _delete(spark, rdd.getCheckpointFile())


def remove_tables(spark: SparkSession) -> None:
    """Delete all that ``as_table`` wrote in this application; frames that read it end with it."""
    _delete(spark, run_folder(spark))


def tasks_for(spark: SparkSession, work: float = 0, per_task: float = 1) -> int:
    """Tasks for ``work`` units at ``per_task`` each, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(work / per_task))


def spread(frame: DataFrame, work: float = 0, per_task: float = 1) -> DataFrame:
    """Split a stored table further when its next step needs more tasks than it has.

    Adaptive execution sizes partitions by bytes. A small table that costs much
    computing per row would otherwise be worked off by one or two tasks.
    """
    tasks = tasks_for(frame.sparkSession, work, per_task)
    if frame.rdd.getNumPartitions() >= tasks:
        return frame
    return frame.repartition(tasks)
