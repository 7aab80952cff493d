"""Queries over coefficient errors, dropped rows, quantile sketches and tables laid out by person."""

import uuid

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions.storage import as_table, run_folder
from claimloom.operators import dropped, inference, rollup, sketches
from claimloom.operators.encoders import feature_names
from claimloom.plans import least_squares, training
from claimloom.plans.registry import query
from claimloom.plans.sql import MERGED, RAW
from claimloom.sources import tables as sources

_OUT = f"{S.FLAG_COLUMN}_Y"
_TERMS = [
    f"{S.CODE_COLUMNS[0]}_freq", f"{S.CODE_COLUMNS[1]}_freq", f"{S.FLAG_COLUMN}_U", *S.NUMERIC_COLUMNS,
]
_UNITS = [("unit_origin", 0, inference.INTERCEPT)] + [
    (f"unit{i}", i + 1 + (i > 2), name) for i, name in enumerate(_TERMS)
]


@query(
    "coefficients",
    f"""WITH {least_squares.inference()}, names(unit, position, term) AS (VALUES {', '.join(map(str, _UNITS))})
    SELECT position, term, round(estimate, 4) AS estimate, round(std_error, 4) AS std_error, round(t, 4) AS t_value,
      round(p, 6) AS p_value FROM inference JOIN names USING (unit)
    UNION ALL SELECT 4, '{_OUT}', NULL, NULL, NULL, NULL""",
)
def coefficients(t):
    """Linear fit of the log charge on the training fold; the last flag level is the one left out."""
    train, test = training.split(t.model_rows())
    data = training.encode(train, test)
    table = inference.coefficient_table(data.train, feature_names(data.encoder), S.LOG_TOTAL, left_out=[_OUT])
    return table.select(
        "position", "term", *[F.round(c, 4).alias(c) for c in ("estimate", "std_error", "t_value")],
        F.round("p_value", 6).alias("p_value"),
    )


_RAW_COLUMNS = ["BENE_ID", "CLM_ID", "PRVDR_STATE_CD", "PRNCPAL_DGNS_CD", "CLM_E_POA_IND_SW1", "CLM_TOT_CHRG_AMT"]
_MISSING = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _RAW_COLUMNS)


@query(
    "drop_report",
    f"WITH {RAW}, counted AS (SELECT *, {_MISSING} AS missing FROM inp) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE missing > 0) AS dropped, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"count(*) FILTER (WHERE {c} IS NULL AND missing = 1) AS dropped_by_it_alone FROM counted"
        for c in _RAW_COLUMNS
    ),
)
def drop_report(t):
    rows = rollup.prepare(t.raw_inpatient(), 1).drop("PATIENT_TYPE")
    _, report = dropped.store_complete(rows)
    return report


_SHARES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query(
    "sketch_quantiles",
    "SELECT e.event_type, 'value' AS column_name, s.share, count(value) AS rows, true AS within_error FROM events e, "
    f"(SELECT unnest({_SHARES})::DOUBLE AS share) s WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2, 3",
)
def sketch_quantiles(t):
    """Quantiles from sketches of days merged per event type, and whether their true ranks are near the wanted ones.

    Near is twice the stated error, which one quantile in 100 may pass.
    """
    rows = t.read("events").select("event_type", F.to_date("ts").alias("day"), "value")
    by_day = sketches.column_sketches(rows, ["value"], ["event_type", "day"])
    found = sketches.sketch_quantiles(sketches.merged(by_day, ["event_type"]), _SHARES, ["event_type"])
    # One row per event type and share.
    ranked = rows.select("event_type", "value").join(F.broadcast(found), "event_type")
    below, upto = (F.count_if(c) / F.first("rows") for c in (
        F.col("value") < F.col("quantile"), F.col("value") <= F.col("quantile")))
    wanted, error = F.col("share"), F.lit(2 * sketches.rank_error())
    return ranked.groupBy("event_type", "column_name", "share", "rows").agg(
        below.alias("below"), upto.alias("upto")
    ).select(
        "event_type", "column_name", "share", "rows",
        ((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("within_error"),
    )


@query(
    "bucketed_join",
    f"""WITH {MERGED} SELECT BENE_ID, count(*) AS rows,
      CAST(sum(CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out) AS DOUBLE) AS charge FROM claims GROUP BY 1""",
)
def bucketed_join(t):
    """Both roll-ups laid out by person, joined and summed per person without another exchange."""
    inp, out = t.rolled_up()
    sides = []
    for side, rows in (("inp", inp), ("out", out)):
        name = f"claims_{side}_{uuid.uuid4().hex}"
        rows = as_table(rows, side)  # counted by person, then laid out
        sources.write_by_key(rows, name, f"{run_folder(t.spark)}/{name}", buckets=8, hot_share=2.0)
        sides.append(t.spark.table(name))
    merged = rollup.merge_sides(*sides)
    charge = F.sum(F.col(S.CHARGE_INP) + F.col(S.CHARGE_OUT)).cast("double")
    return merged.groupBy(S.GROUP_KEY).agg(F.count(F.lit(1)).alias("rows"), charge.alias("charge"))
