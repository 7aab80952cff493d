"""Cleaning and scalar derivations."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S


def keep_listed(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the table's own order."""
    return frame.select(*[c for c in frame.columns if c in set(names)])


def absolute_ids(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn ids into non-negative longs."""
    return frame.withColumns({c: F.abs(F.col(c).cast("long")) for c in columns})


def drop_incomplete(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (all columns by default)."""
    return frame.dropna("any", subset=list(columns) if columns else None)


def bare_number(column: Column | str) -> Column:
    """A currency text without its marks and white space.

    U+00A0 is named on its own because Java's white-space class leaves it out.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.regexp_replace(text, r"[$,\s\u00A0]", "")


def parse_currency(column: Column | str) -> Column:
    """Number in a currency text; null when nothing numeric is left."""
    number = bare_number(column).try_cast("double")
    return F.when(F.isnan(number), F.lit(None)).otherwise(number)


def tier_of(charge: Column, edges: Sequence = S.TIER_EDGES, labels: Sequence[int] = S.TIERS) -> Column:
    """Label of the right-closed interval that holds ``charge``; null for null."""
    label = F.when(charge.isNull(), F.lit(None).cast("int"))
    for edge, value in zip(edges, labels):
        label = label.when(charge <= F.lit(edge), F.lit(value))
    return label.otherwise(F.lit(labels[-1]))


def add_targets(frame: DataFrame) -> DataFrame:
    """Add the total charge, its natural log and its tier."""
    total = F.col(S.CHARGE_INP) + F.col(S.CHARGE_OUT)
    return frame.withColumns(
        {
            S.TOTAL: total.cast("double"),
            S.LOG_TOTAL: F.ln(total.cast("double")),
            S.TIER: tier_of(total),
        }
    )


def feature_frame(frame: DataFrame) -> DataFrame:
    """The model inputs, in their fixed order."""
    return frame.select(*S.FEATURES)


def tier_description(tier: Column) -> Column:
    """Reviewer text for a tier."""
    pairs = [F.lit(x) for item in S.TIER_DESCRIPTIONS.items() for x in item]
    return F.create_map(*pairs)[tier]


def normalise_code(column: Column | str) -> Column:
    """Trimmed, upper-case form of a typed code."""
    return F.upper(F.trim(F.col(column) if isinstance(column, str) else column))


def to_zero_based(tier: Column) -> Column:
    return (tier - F.lit(1)).cast("double")


def to_tier(label: Column) -> Column:
    return (label + F.lit(1)).cast("int")


def to_dollars(log_charge: Column) -> Column:
    return F.exp(log_charge)


def is_procedure_code(code: Column) -> Column:
    """A well-formed code that is not a diagnosis code."""
    return code.rlike(S.CODE_PATTERN) & ~code.rlike(S.DIAGNOSIS_PATTERN)


def preview(frame: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return frame.orderBy(*order).limit(n)
