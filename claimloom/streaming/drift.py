"""Drift of arriving batches against a static reference."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom.functions.storage import as_table
from claimloom.operators import drift, sketches


def start_batch_drift(
    rows: DataFrame,
    reference: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    output: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Compare every micro-batch with the reference; one result folder per batch."""
    edges = {c: drift.reference_bins(reference, c) for c in numeric}
    fixed = as_table(reference.select(*categorical, *numeric), "reference")

    def write(batch: DataFrame, batch_id: int) -> None:
        current = batch.withColumn("batch", F.lit(batch_id))
        scores = drift.batch_drift(fixed, current, "batch", categorical, edges)
        scores.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def window_counts(
    rows: DataFrame, time: str, columns: Sequence[str], length: str, delay: str
) -> DataFrame:
    """Rows per time window, column and value; late rows count until ``delay``.

    State holds one count per open window and value, not rows.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        rows.withWatermark(time, delay)
        .select(time, F.inline(pairs))
        .groupBy(F.window(time, length).alias("window"), "column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("window.start").alias("window_start"), "column_name", "value", "rows")
    )


def start_window_counts(counts: DataFrame, output: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the counts of closed windows to a Parquet table."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def window_drift(counts: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance of every closed window from the reference."""
    return drift.drift_of_counts(counts, reference, "window_start", columns)


def start_window_sketches(
    rows: DataFrame, time: str, columns: Sequence[str], length: str, output: str, checkpoint: str,
    k: int = sketches.K, **trigger,
) -> StreamingQuery:
    """Append a quantile sketch per time window and column for every micro-batch; nothing is held as state.

    A window's sketches of all batches merge into its own (:func:`merged_windows`), so late rows count whenever they
    come. A batch that is repeated after a failure replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("window_start", F.window(time, length)["start"])
        found = sketches.column_sketches(placed, columns, ["window_start"], k)
        found.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def merged_windows(stored: DataFrame, k: int = sketches.K) -> DataFrame:
    """One sketch per window and column from those of all batches."""
    return sketches.merged(stored, ["window_start"], k)
