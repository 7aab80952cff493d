"""Drift between a reference and a current table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom import settings as S
from claimloom.functions.ranks import exact_quantiles, ordered_value, running_totals
from claimloom.functions.storage import as_table
from claimloom.operators.profile import unpivot

# Smallest reference deviation, and the share that stands for an
# empty cell in the population stability index.
MIN_DEVIATION = 0.001
EMPTY_SHARE = 0.0001

# Score of a column that has values on one side only; without values on both sides it is 0.
FULL_DRIFT = 1.0


def column_roles(
    reference: DataFrame,
    categorical: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
) -> tuple[list[str], list[str]]:
    """``(numeric, categorical)`` columns: text is categorical unless stated."""
    text = [f.name for f in reference.schema if isinstance(f.dataType, T.StringType)]
    as_text = list(categorical) if categorical is not None else [
        c for c in text if c not in (numeric or [])
    ]
    return [c for c in reference.columns if c not in as_text], as_text


def _stacked_counts(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str
) -> DataFrame:
    """Reference and current rows per column and value; all columns in one job."""
    both = unpivot(reference, columns, kind).withColumn("is_ref", F.lit(1)).unionByName(
        unpivot(current, columns, kind).withColumn("is_ref", F.lit(0))
    )
    return (
        both.filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(
            F.sum("is_ref").alias("ref"),
            F.sum(1 - F.col("is_ref")).alias("cur"),
        )
    )


def _one_row_each(scores: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A row for every requested column, also when it holds no value at all."""
    asked = scores.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return asked.join(scores, "column_name", "left").select(
        "column_name", *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names]
    )


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scaled Wasserstein-1 distance and two-sample KS statistic per column.

    Null and NaN are no values. A column with values on one side only scores ``FULL_DRIFT``.
    """
    counts = _stacked_counts(reference, current, columns, "double")
    ordered = running_totals(counts, ["column_name"], "value", ["ref", "cur"])
    gap = F.abs(
        F.try_divide(F.col("before_ref") + F.col("ref"), F.col("total_ref"))
        - F.try_divide(F.col("before_cur") + F.col("cur"), F.col("total_cur"))
    )
    one_side = (F.max("total_ref") == 0) | (F.max("total_cur") == 0)
    distances = ordered.groupBy("column_name").agg(
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("distance"),
        F.max(gap).alias("ks"),
        one_side.alias("one_side"),
    )
    spread = (
        unpivot(reference, columns, "double").filter(ordered_value("value")).groupBy("column_name").agg(
            F.greatest(F.stddev_pop("value"), F.lit(MIN_DEVIATION)).alias("deviation")
        )
    )
    scores = distances.join(F.broadcast(spread), "column_name", "left").select(
        "column_name",
        F.when(F.col("one_side"), FULL_DRIFT).otherwise(F.col("distance") / F.col("deviation")).alias("wasserstein"),
        F.when(F.col("one_side"), FULL_DRIFT).otherwise(F.col("ks")).alias("ks"),
    )
    return _one_row_each(scores, columns, ("wasserstein", "ks"))


def _divergence(p: Column, q: Column) -> Column:
    """One cell's part of the Jensen-Shannon divergence, base 2."""
    middle = (p + q) / 2
    left = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
    right = F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)
    return (left + right) / 2


def _stability(p: Column, q: Column) -> Column:
    a, b = F.greatest(p, F.lit(EMPTY_SHARE)), F.greatest(q, F.lit(EMPTY_SHARE))
    return (b - a) * F.ln(b / a)


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance, chi-square statistic and stability index per column.

    A column with values on one side only has the distance ``FULL_DRIFT`` and a
    chi-square of 0, because no counts can be expected for the other side.
    """
    counts = _stacked_counts(reference, current, columns, "string")
    totals = counts.groupBy("column_name").agg(
        F.sum("ref").cast("double").alias("ref_rows"), F.sum("cur").cast("double").alias("cur_rows")
    )
    cells = counts.join(F.broadcast(totals), "column_name")
    p, q = (
        F.coalesce(F.try_divide(F.col(c), F.col(n)), F.lit(0.0)) for c, n in (("ref", "ref_rows"), ("cur", "cur_rows"))
    )
    pooled = (F.col("ref") + F.col("cur")) / (F.col("ref_rows") + F.col("cur_rows"))
    chi = sum(
        F.coalesce(F.try_divide(F.pow(F.col(c) - pooled * F.col(n), F.lit(2)), pooled * F.col(n)), F.lit(0.0))
        for c, n in (("ref", "ref_rows"), ("cur", "cur_rows"))
    )
    one_side = (F.max("ref_rows") == 0) | (F.max("cur_rows") == 0)
    distance = F.sqrt(F.greatest(F.sum(_divergence(p, q)), F.lit(0.0)))
    scores = cells.groupBy("column_name").agg(
        F.when(one_side, FULL_DRIFT).otherwise(distance).alias("jensen_shannon"),
        F.sum(chi).alias("chi_square"),
        F.sum(_stability(p, q)).alias("psi"),
    )
    return _one_row_each(scores, columns, ("jensen_shannon", "chi_square", "psi"))


def column_scores(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    threshold: float = S.DRIFT_THRESHOLD,
) -> DataFrame:
    """One score per column: Wasserstein for numbers, Jensen-Shannon for texts."""
    parts = []
    if numeric:
        parts.append(
            numeric_drift(reference, current, numeric).select(
                "column_name", F.lit("wasserstein").alias("statistic"), F.col("wasserstein").alias("score")
            )
        )
    if categorical:
        parts.append(
            categorical_drift(reference, current, categorical).select(
                "column_name", F.lit("jensen_shannon").alias("statistic"),
                F.col("jensen_shannon").alias("score"),
            )
        )
    scores = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return scores.withColumn("drifted", F.col("score") >= threshold)


def summarise(scores: DataFrame) -> DataFrame:
    """Number and share of drifted columns."""
    return scores.agg(
        F.count_if("drifted").alias("drifted_columns"),
        F.count(F.lit(1)).alias("columns"),
        F.avg(F.col("drifted").cast("double")).alias("drifted_share"),
    )


def reference_bins(reference: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Inner edges that cut the reference into equal shares."""
    probabilities = {f"q{i}": i / bins for i in range(1, bins)}
    row = exact_quantiles(
        reference.select(F.lit(column).alias("column_name"), F.col(column).cast("double").alias("value")),
        ["column_name"],
        "value",
        probabilities,
    ).first()
    return sorted({float(v) for v in row.asDict().values() if isinstance(v, float)}) if row else []


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Number of the right-closed bin holding ``value``, as text; null for null."""
    number = F.when(value.isNull(), F.lit(None).cast("string"))
    for i, edge in enumerate(edges):
        number = number.when(value <= F.lit(edge), F.lit(str(i)))
    return number.otherwise(F.lit(str(len(edges))))


def batch_drift(
    reference: DataFrame,
    current: DataFrame,
    batch: str,
    categorical: Sequence[str],
    edges: dict[str, list[float]],
) -> DataFrame:
    """Jensen-Shannon distance of every batch from one reference, per column.

    Numbers are compared by the reference bins in ``edges``. A value absent from a
    batch adds half its reference share, so batches need not be filled up first. Every batch
    seen has a row for every column; a column without values in it, or in the
    reference, scores ``FULL_DRIFT``, or 0 when neither has any.
    """

    def as_text(frame: DataFrame) -> DataFrame:
        binned = {c: bin_of(F.col(c).cast("double"), e) for c, e in edges.items()}
        return frame.withColumns(binned) if binned else frame

    columns = [*categorical, *edges]
    counts = (
        as_text(current)
        .select(batch, F.inline(_pairs(columns)))
        .groupBy(batch, "column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # Stored, so that an arriving batch is read once.
    return drift_of_counts(as_table(counts, "counts"), as_text(reference), batch, columns)


def _pairs(columns: Sequence[str]) -> Column:
    return F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )


def drift_of_counts(
    counts: DataFrame, reference: DataFrame, batch: str, columns: Sequence[str]
) -> DataFrame:
    """The same from counts per batch, column and value that already exist."""
    ref_counts = (
        reference.select(F.inline(_pairs(columns)))
        .filter("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("ref"))
    )
    ref_totals = ref_counts.groupBy("column_name").agg(F.sum("ref").alias("ref_rows"))
    shares = ref_counts.join(F.broadcast(ref_totals), "column_name").select(
        "column_name", "value", (F.col("ref") / F.col("ref_rows")).alias("p")
    )
    known = counts.filter("value IS NOT NULL").withColumnRenamed("rows", "cur")
    totals = known.groupBy(batch, "column_name").agg(F.sum("cur").alias("rows"))
    cells = (
        known.join(totals, [batch, "column_name"])
        .join(shares, ["column_name", "value"], "left")
        .withColumn("p", F.coalesce("p", F.lit(0.0)))
    )
    q = F.col("cur") / F.col("rows")
    absent = (1 - F.sum("p")) / 2
    scores = cells.groupBy(batch, "column_name").agg(
        F.max("rows").alias("known_rows"),
        F.sqrt(F.greatest(F.sum(_divergence(F.col("p"), q)) + absent, F.lit(0.0))).alias("score"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    asked = counts.select(batch).distinct().select(batch, F.explode(names).alias("column_name"))
    # One row per column.
    known_reference = F.broadcast(ref_totals)
    return (
        asked.join(scores, [batch, "column_name"], "left")
        .join(known_reference, "column_name", "left")
        .select(
            batch,
            "column_name",
            F.coalesce("known_rows", F.lit(0)).cast("long").alias("rows"),
            F.coalesce("score", F.when(F.col("ref_rows") > 0, FULL_DRIFT), F.lit(0.0)).alias("jensen_shannon"),
        )
    )
