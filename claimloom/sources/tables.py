"""Readers and writers for claims, lookups, batches and reports."""

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom import settings as S
from claimloom.functions import clean


def _suffix(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def read_cells(spark: SparkSession, path: str, schema: T.StructType, needed: bool = True) -> DataFrame:
    """A CSV file's columns of ``schema``, found by header name, typed, with ``errors`` per row.

    Money may carry currency marks. A cell that holds something unreadable becomes null and is named in
    ``errors`` as ``column: text``. A column that is missing is an error if ``needed``.
    """
    cells = spark.read.csv(path, header=True, inferSchema=False)
    missing = [f.name for f in schema if f.name not in cells.columns]
    if missing and needed:
        raise ValueError(f"{path} has no column {missing[0]}")
    listed = [f for f in schema if f.name in cells.columns]
    typed, lost = [], []
    for field in listed:
        cell = F.col(field.name)
        money = isinstance(field.dataType, T.DecimalType)
        value = clean.bare_number(cell).try_cast(field.dataType) if money else cell.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        lost.append(F.when(cell.isNotNull() & value.isNull(), F.concat(F.lit(f"{field.name}: "), cell)))
    return cells.select(*typed, F.array_compact(F.array(*lost)).alias("errors"))


def readable(checked: DataFrame) -> DataFrame:
    """The rows of :func:`read_cells` without unreadable cells."""
    return checked.filter(F.size("errors") == 0).drop("errors")


def unreadable(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def _all_readable(checked: DataFrame) -> DataFrame:
    """All rows; running over an unreadable cell ends the job with its text."""
    failed = F.raise_error(F.concat_ws("; ", F.lit("unreadable cells"), F.col("errors"))).cast("boolean")
    return checked.filter(F.when(F.size("errors") > 0, failed).otherwise(True)).drop("errors")


def load_claims(spark: SparkSession, path: str) -> DataFrame:
    """Read the merged claims table from Parquet, or CSV with a header."""
    if _suffix(path) == ".csv":
        return _all_readable(read_cells(spark, path, S.CLAIMS_SCHEMA))
    return spark.read.schema(S.CLAIMS_SCHEMA).parquet(path)


def load_income(spark: SparkSession, path: str) -> DataFrame:
    """Read the income lookup and turn its currency texts into numbers."""
    if _suffix(path) == ".csv":
        income = _all_readable(read_cells(spark, path, S.INCOME_SCHEMA))
    else:
        income = spark.read.parquet(path)
    return clean_income(income)


def clean_income(income: DataFrame) -> DataFrame:
    return income.withColumn(S.INCOME, clean.parse_currency(S.INCOME))


def load_raw_extract(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """Read a raw inpatient or outpatient CSV, matching columns by header name.

    Only the listed columns are parsed; the extracts carry many more. Rows with unreadable cells are
    written to ``rejects`` and left out; without a place for them they end the job.
    """
    checked = read_cells(spark, path, S.RAW_SCHEMA, needed=False)
    if rejects is None:
        return _all_readable(checked)
    unreadable(checked).write.mode("overwrite").parquet(rejects)
    return readable(checked)


def load_current(spark: SparkSession, path: str | None, typed: bool = True) -> DataFrame | None:
    """Read an incoming batch, CSV or Parquet by suffix; ``None`` stays ``None``.

    With ``typed`` the feature columns of a CSV are cast and unreadable cells are null;
    without, all cells stay text for rules that tell a bad cell from a missing one.
    """
    if path is None:
        return None
    kind = _suffix(path)
    if kind == ".csv":
        found = spark.read.csv(path, header=True)
        known = {f.name: f.dataType for f in S.FEATURE_SCHEMA} if typed else {}
        return found.select(
            *[found[c].try_cast(known[c]).alias(c) if c in known else found[c] for c in found.columns]
        )
    if kind in (".parquet", ".pq"):
        return spark.read.parquet(path)
    raise ValueError(f"Unsupported file type for drift input: {kind}")


def load_background(spark: SparkSession, path: str) -> DataFrame | None:
    """Read the background sample, or ``None`` when it was not exported."""
    try:
        return _all_readable(read_cells(spark, path, S.FEATURE_SCHEMA))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_claims(frame: DataFrame, path: str) -> None:
    """Write the merged claims table, replacing an earlier one."""
    frame.write.mode("overwrite").parquet(path)


def write_by_key(
    frame: DataFrame, name: str, path: str, key: str = S.GROUP_KEY, buckets: int = 200, hot_share: float = 1.0
) -> bool:
    """Save a catalogue table ``name`` at ``path`` with the rows of a key together, replacing an earlier one.

    Grouping by the key, and joining tables with the same number of buckets on it, then need no exchange, as often as
    the table is read. Take buckets that hold some 200 MB each. A bucket is one task's work: if a single key has
    more than ``hot_share`` of an even bucket's rows, the table is saved without buckets, where adaptive execution
    can split the key. Returns whether buckets were made.
    """
    counts = frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    even = (facts["most"] or 0) <= hot_share * max((facts["rows"] or 0) / buckets, 1)
    placed = frame
    if even:
        # One task per bucket, or each task would write a file for every bucket.
        placed = frame.repartition(buckets, key)
    writer = placed.write.mode("overwrite").option("path", path).format("parquet")
    if even:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return even


def write_background(sample: DataFrame, path: str) -> None:
    """Write the background sample as CSV with a header and no index."""
    sample.write.mode("overwrite").csv(path, header=True)


def write_report(tables: dict[str, DataFrame], path: str, kind: str = "parquet") -> None:
    """Write each named result table of a report below ``path``."""
    for name, table in tables.items():
        table.write.mode("overwrite").format(kind).save(f"{path}/{name}")
