"""Column summaries, counts and frequency tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.ranks import exact_quantiles


def unpivot(frame: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Long form: one row per row and column, cast to ``kind``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns]
    )
    return frame.select(F.inline(pairs))


def distribution(frame: DataFrame, column: str) -> DataFrame:
    """Rows and share of rows per value."""
    counts = frame.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    # Summed from the counts, whose exchange both sides share.
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.withColumn("share", F.round(F.col("rows") / total, 6))


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    return frame.select(column).distinct()


def distinct_count(frame: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct values; the approximate form needs no shuffle of values."""
    if approximate:
        return frame.agg(F.approx_count_distinct(column).alias("distinct_values"))
    return frame.agg(F.count_distinct(column).alias("distinct_values"))


def null_counts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    columns = list(columns or frame.columns)
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def numeric_summary(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    statistics = {
        "rows": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    # The moments need no long form and no shuffle of rows.
    wide = frame.agg(
        *[
            function(F.col(c).cast("double")).alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, function in statistics.items()
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{i}").alias(n) for n in statistics])
            for i, c in enumerate(columns)
        ]
    )
    quartiles = exact_quantiles(
        unpivot(frame, columns, "double"), ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    return wide.select(F.inline(rows)).join(quartiles, "column_name", "left")


def scaler_statistics(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column; a zero deviation scales by one."""
    aggregates = [
        a
        for c in columns
        for a in (
            F.avg(F.col(c).cast("double")).alias(f"mean_{c}"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}"),
        )
    ]
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"mean_{c}").alias("mean"),
                F.when(F.col(f"std_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"std_{c}")).alias("scale"),
            )
            for c in columns
        ]
    )
    return frame.agg(*aggregates).select(F.inline(pairs))


def histogram(frame: DataFrame, column: str, low: float, width: float) -> DataFrame:
    """Rows per bin of fixed width; a bin holds its lower edge."""
    bin_no = F.floor((F.col(column).cast("double") - F.lit(low)) / F.lit(width))
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("bin_start", F.lit(low) + F.col("bin") * F.lit(width))
    )


def frequency_table(frame: DataFrame, columns: Sequence[str], normalize: bool = True) -> DataFrame:
    """Share (or count) of non-null rows per column and value."""
    long = unpivot(frame, columns, "string").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    if not normalize:
        return counts.withColumn("frequency", F.col("rows").cast("double"))
    # One total per column; taken from the counts, so rows are read once.
    totals = counts.groupBy("column_name").agg(F.sum("rows").alias("total"))
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", "rows", (F.col("rows") / F.col("total")).alias("frequency")
    )


def codes_by_frequency(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each code with how often it occurs, per column; the list of a frequency is its rows."""
    return (
        unpivot(frame, columns, "string")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", F.col("value").alias("code"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def group_multiplicity(frame: DataFrame, key: str) -> DataFrame:
    """How many rows a key has: number of keys, mean, least and most."""
    return value_counts(frame, key).agg(
        F.count(F.lit(1)).alias("keys"),
        F.avg("rows").alias("mean_rows"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
    )


def distinct_rows(frame: DataFrame) -> DataFrame:
    return frame.distinct()
