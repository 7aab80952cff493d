"""Lookup joins and the modeling table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.skew import broadcast_if_small, lookup_join


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Left join with a lookup of one row per key; unmatched rows get nulls."""
    renamed = lookup.withColumnRenamed(lookup_key, key)
    marked = broadcast_if_small(renamed)
    if marked is not renamed:
        return rows.join(marked, key, "left")
    return lookup_join(rows, renamed, [key], "left")


def merge_income(claims: DataFrame, income: DataFrame) -> DataFrame:
    """Attach the state's median income by the inpatient state."""
    return join_lookup(claims, income, S.STATE_INP, S.STATE_KEY)


def unmatched_keys(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Keys without a lookup row and how many rows they leave unmatched."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(lookup, F.col(key) == F.col(lookup_key), "left_anti")


def modeling_frame(claims: DataFrame, income: DataFrame) -> DataFrame:
    """Claims with income and the three targets."""
    return clean.add_targets(merge_income(claims, income))
