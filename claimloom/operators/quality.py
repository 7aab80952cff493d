"""Declared constraints: violation counts, quarantine and schema checks."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom import settings as S
from claimloom.functions import clean


class SchemaError(ValueError):
    """A table breaks a declared rule."""


@dataclass(frozen=True)
class Rule:
    """A named condition that is true on rows breaking the rule."""

    name: str
    broken: Column
    message: str = ""


@dataclass(frozen=True)
class Schema:
    """Declared types, row rules in order, and columns without repeats."""

    types: dict[str, str]
    rules: tuple[Rule, ...]
    unique: tuple[str, ...] = ()


def _fails(condition: Column) -> Column:
    """A check on a null value is not broken; ``not_null`` covers nulls."""
    return F.coalesce(~condition, F.lit(False))


def not_null(name: str) -> Rule:
    return Rule(f"{name}:not_null", F.col(name).isNull(), f"{name} is null")


def matches(name: str, pattern: str) -> Rule:
    return Rule(f"{name}:matches", _fails(F.col(name).rlike(pattern)), f"{name} does not match {pattern}")


def is_in(name: str, values: Sequence) -> Rule:
    return Rule(f"{name}:is_in", _fails(F.col(name).isin(*values)), f"{name} is not one of {list(values)}")


def in_range(name: str, low, high) -> Rule:
    return Rule(
        f"{name}:in_range", _fails(F.col(name).between(low, high)), f"{name} is outside {low}..{high}"
    )


def at_least(name: str, low) -> Rule:
    return Rule(f"{name}:at_least", _fails(F.col(name) >= low), f"{name} is below {low}")


def above(name: str, low) -> Rule:
    return Rule(f"{name}:above", _fails(F.col(name) > low), f"{name} is not above {low}")


def min_length(name: str, n: int) -> Rule:
    return Rule(f"{name}:min_length", _fails(F.length(name) >= n), f"{name} is shorter than {n}")


def columns_agree(a: str, b: str) -> Rule:
    return Rule(f"{a}={b}:agree", ~F.col(a).eqNullSafe(F.col(b)), f"{a} and {b} disagree")


def claims_schema() -> Schema:
    """Rules of the merged claims table. Codes are gated by pattern here."""
    inp, out = S.CODE_COLUMNS
    low, high = S.STATE_RANGE
    columns = [
        (S.GROUP_KEY, "bigint", []),
        (inp, "string", [matches(inp, S.CODE_PATTERN)]),
        (out, "string", [matches(out, S.CODE_PATTERN)]),
        (S.FLAG_COLUMN, "string", [is_in(S.FLAG_COLUMN, S.FLAG_VALUES)]),
        (S.STATE_INP, "int", [in_range(S.STATE_INP, low, high)]),
        (S.STATE_OUT, "int", [in_range(S.STATE_OUT, low, high)]),
        ("Number_of_Claims_inp", "bigint", [at_least("Number_of_Claims_inp", 0)]),
        ("Number_of_Claims_out", "bigint", [at_least("Number_of_Claims_out", 0)]),
        (S.CHARGE_INP, "decimal(18,2)", [above(S.CHARGE_INP, 0)]),
        (S.CHARGE_OUT, "decimal(18,2)", [above(S.CHARGE_OUT, 0)]),
    ]
    rules = [r for name, _, checks in columns for r in (not_null(name), *checks)]
    return Schema(
        {name: kind for name, kind, _ in columns},
        (*rules, columns_agree(S.STATE_INP, S.STATE_OUT)),
    )


def income_schema() -> Schema:
    """Rules of the income lookup."""
    low, high = S.STATE_RANGE
    return Schema(
        {S.STATE_KEY: "int", "STATE": "string", S.INCOME: "double"},
        (
            not_null(S.STATE_KEY),
            in_range(S.STATE_KEY, low, high),
            not_null("STATE"),
            not_null(S.INCOME),
            above(S.INCOME, 0),
        ),
        unique=(S.STATE_KEY,),
    )


def modeling_schema() -> Schema:
    """Rules of the modeling table. A null income is a state without a lookup row."""
    return Schema(
        {S.TOTAL: "double", S.LOG_TOTAL: "double", S.TIER: "int", S.INCOME: "double"},
        (
            not_null(S.TOTAL),
            above(S.TOTAL, 0),
            not_null(S.LOG_TOTAL),
            not_null(S.TIER),
            is_in(S.TIER, S.TIERS),
            not_null(S.INCOME),
            above(S.INCOME, 0),
        ),
    )


def scoring_rules() -> tuple[Rule, ...]:
    """Rules of a row to be scored: any non-empty code is accepted."""
    checks = {
        S.CODE_COLUMNS[0]: min_length(S.CODE_COLUMNS[0], 1),
        S.CODE_COLUMNS[1]: min_length(S.CODE_COLUMNS[1], 1),
        S.FLAG_COLUMN: is_in(S.FLAG_COLUMN, S.FLAG_VALUES),
        "Number_of_Claims_inp": at_least("Number_of_Claims_inp", 0),
        "Number_of_Claims_out": at_least("Number_of_Claims_out", 0),
        S.INCOME: above(S.INCOME, 0),
    }
    return tuple(r for name, check in checks.items() for r in (not_null(name), check))


def violations(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking each rule, counted for all rules in a single pass."""
    counts = frame.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("rule_no"), F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("rows"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(pairs))


def with_errors(frame: DataFrame, rules: Sequence[Rule], column: str = "errors") -> DataFrame:
    """Attach the list of broken rules; empty when the row is fine."""
    reasons = F.array(*[F.when(r.broken, F.lit(r.message or r.name)) for r in rules])
    return frame.withColumn(column, F.array_compact(reasons))


def accepted(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return with_errors(frame, rules).filter(F.size("errors") == 0).drop("errors")


def quarantine(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return with_errors(frame, rules).filter(F.size("errors") > 0)


def repeated_values(frame: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        frame.groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def coerce(frame: DataFrame, types: dict[str, str]) -> tuple[DataFrame, tuple[Rule, ...]]:
    """Cast to declared types; uncastable values become rules on the cast table.

    Columns that are not declared are kept.
    """
    present = {c: t for c, t in types.items() if c in frame.columns}
    lost = {
        c: F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()
        if isinstance(frame.schema[c].dataType, T.StringType)
        else F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        for c, t in present.items()
    }
    flagged = frame.withColumns({f"__lost_{c}": lost[c] for c in present})
    cast = flagged.withColumns({c: F.col(c).try_cast(t) for c, t in present.items()})
    rules = tuple(
        Rule(f"{c}:type", F.col(f"__lost_{c}"), f"{c} is not {t}") for c, t in present.items()
    )
    return cast, rules


def validate(frame: DataFrame, schema: Schema) -> DataFrame:
    """The coerced table, or ``SchemaError`` naming the first broken rule."""
    missing = [c for c in schema.types if c not in frame.columns]
    if missing:
        raise SchemaError(f"missing column {missing[0]}")
    cast, type_rules = coerce(frame, schema.types)
    rules = (*type_rules, *schema.rules)
    for row in sorted(violations(cast, rules).collect(), key=lambda r: r.rule_no):
        if row.rows:
            broken = rules[row.rule_no]
            raise SchemaError(f"{broken.message or broken.name} ({row.rows} rows)")
    for column in schema.unique:
        if repeated_values(cast, column).limit(1).count():
            raise SchemaError(f"{column} repeats")
    return cast.drop(*[f"__lost_{c}" for c in schema.types])


def validate_claims(frame: DataFrame) -> DataFrame:
    return validate(frame, claims_schema())


def validate_income(frame: DataFrame) -> DataFrame:
    return validate(frame, income_schema())


def validate_modeling_frame(frame: DataFrame) -> DataFrame:
    return validate(frame, modeling_schema())


def procedure_codes(frame: DataFrame, columns: Sequence[str] = tuple(S.CODE_COLUMNS)) -> DataFrame:
    """Distinct procedure codes found in diagnosis columns; reported, never raised.

    One row per column and code. A clean column has no row.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("code")) for c in columns]
    )
    return (
        frame.select(F.inline(pairs))
        .filter(clean.is_procedure_code(F.col("code")))
        .groupBy("column_name", "code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
