"""Coefficients of a weighted least-squares fit with their errors."""

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTERCEPT = "(intercept)"

# Least eigenvalue of the columns' correlations below which they count as collinear.
SINGULAR = 1e-12


def coefficient_table(
    frame: DataFrame,
    names: Sequence[str],
    label: str,
    features: str = "features",
    weight: str | None = None,
    left_out: Sequence[str] = (),
) -> DataFrame:
    """``term``, ``estimate``, ``std_error``, ``t_value`` and two-sided ``p_value``, the intercept first.

    The fit is MLlib's on the weighted normal equations: one pass gathers a matrix of columns by columns (at most 4,096
    columns), and its inverse gives the covariance of the estimates. Of columns that add up to a constant, such
    as the flags of all levels of a text, one has to be named in ``left_out``. Constant columns are left out by
    themselves. Left-out terms have nulls. Other collinear columns, or no more rows than columns, raise ``ValueError``.
    """
    used = frame.filter(F.col(label).isNotNull())
    if used.isEmpty():
        raise ValueError("0 rows determine no columns")
    facts = used.agg(
        F.count(F.lit(1)).alias("rows"), Summarizer.metrics("variance").summary(F.col(features)).alias("s")
    ).select("rows", "s.variance").first()
    spread = facts["variance"].toArray()
    kept = [i for i, name in enumerate(names) if name not in set(left_out) and spread[i] > 0]
    if facts["rows"] <= len(kept) + 1:
        raise ValueError(f"{facts['rows']} rows do not determine {len(kept)} columns and their errors")
    sliced = VectorSlicer(inputCol=features, outputCol="__kept", indices=kept).transform(used)
    # A singular system may pass for a regular one by rounding, so its columns are looked at first.
    if len(kept) > 1 and np.linalg.eigvalsh(Correlation.corr(sliced, "__kept").first()[0].toArray())[0] < SINGULAR:
        raise ValueError("collinear columns have no errors; name one of them in left_out")
    model = LinearRegression(
        featuresCol="__kept", labelCol=label, predictionCol="__fit", solver="normal", regParam=0.0,
        **({"weightCol": weight} if weight else {}),
    )
    fitted = model.fit(sliced)
    summary = fitted.summary
    # The intercept is last in each list.
    errors, t, p = summary.coefficientStandardErrors, summary.tValues, summary.pValues
    estimates = [*fitted.coefficients.toArray(), fitted.intercept]
    found = dict(zip([*kept, -1], zip(estimates, errors, t, p)))
    terms = [(-1, INTERCEPT), *enumerate(names)]
    rows = [(i + 1, term, *map(float, found[i])) if i in found else (i + 1, term, *[None] * 4) for i, term in terms]
    schema = "position int, term string, estimate double, std_error double, t_value double, p_value double"
    return frame.sparkSession.createDataFrame(rows, schema)
