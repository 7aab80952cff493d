"""What a drop of incomplete rows costs, column by column, counted in the pass that writes the rows."""

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import clean
from claimloom.functions.storage import as_table


@dataclass(frozen=True)
class DropReport:
    """Counts of an observed table; known once an action has run over it."""

    observation: Observation
    columns: tuple[str, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per column: ``rows``, ``dropped`` (rows with a null anywhere), ``nulls`` of the column, and
        ``dropped_by_it_alone``, the rows that would stay without this column. Waits for the first action.
        """
        # Spark may prune an empty input together with its counts.
        seen = defaultdict(int, self.observation.get)
        rows = [
            (c, seen["rows"], seen["rows"] - seen["complete"], seen[f"nulls_{i}"], seen[f"alone_{i}"])
            for i, c in enumerate(self.columns)
        ]
        schema = "column_name string, rows long, dropped long, nulls long, dropped_by_it_alone long"
        return spark.createDataFrame(rows, schema)


def observed(frame: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DropReport]:
    """The same rows, and a report of nulls in ``columns`` (default: all) that the first action over them fills.

    The counts are exact where the rows are written or collected without a later shuffle: a task then
    counts once. Behind a shuffle, tasks that a lost executor makes Spark repeat count again.
    """
    columns = tuple(columns or frame.columns)
    nulls = [F.col(c).isNull() for c in columns]
    missing = reduce(Column.__add__, [n.cast("int") for n in nulls])
    observation = Observation()
    watched = frame.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(missing == 0).alias("complete"),
        *[F.count_if(n).alias(f"nulls_{i}") for i, n in enumerate(nulls)],
        *[F.count_if(n & (missing == 1)).alias(f"alone_{i}") for i, n in enumerate(nulls)],
    )
    return watched, DropReport(observation, columns)


def store_complete(
    frame: DataFrame, columns: Sequence[str] | None = None, name: str = "complete"
) -> tuple[DataFrame, DataFrame]:
    """``(rows, report)``: the rows without nulls in ``columns``, stored, and what was dropped. One pass."""
    watched, report = observed(frame, columns)
    kept = as_table(clean.drop_incomplete(watched, columns), name)
    return kept, report.table(frame.sparkSession)
