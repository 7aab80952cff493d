"""Classification and regression metrics as aggregates over predictions."""

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions.ranks import exact_quantiles, running_totals


def confusion_matrix(
    frame: DataFrame, labels: Sequence, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Counts over a fixed label list: one row per true label, one column per prediction."""
    cells = {
        (i, j): f"c_{i}_{j}" for i in range(len(labels)) for j in range(len(labels))
    }
    counts = frame.agg(
        *[
            F.count_if((F.col(label) == labels[i]) & (F.col(prediction) == labels[j])).alias(name)
            for (i, j), name in cells.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(f"true_{labels[i]}").alias("truth"),
            *[F.col(cells[i, j]).alias(f"pred_{labels[j]}") for j in range(len(labels))],
        )
        for i in range(len(labels))
    ]
    return counts.select(F.inline(F.array(*rows)))


def confusion_counts(
    frame: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Long confusion counts: one row per pair of labels that occurs."""
    return frame.groupBy(
        F.col(label).cast("int").alias("truth"), F.col(prediction).cast("int").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))


def per_class(counts: DataFrame) -> DataFrame:
    """Hits, true rows, predicted rows and F1 per class in truth or prediction."""
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("truth").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"),
            hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("guess").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"),
            zero.alias("hits"),
        ),
    )
    sums = (
        counts.select(F.inline(sides))
        .groupBy("cls")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
             F.sum("hits").alias("hits"))
    )
    return sums.withColumn("f1", 2 * F.col("hits") / (F.col("support") + F.col("predicted")))


def classification_metrics(
    frame: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, macro F1, F1 weighted by support, selection score."""
    classes = per_class(confusion_counts(frame, label, prediction))
    row = classes.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )
    return row.withColumn("selection_score", selection_score())


def selection_score(macro_f1: str = "macro_f1", accuracy: str = "accuracy"):
    return S.MACRO_F1_WEIGHT * F.col(macro_f1) + S.ACCURACY_WEIGHT * F.col(accuracy)


def _class_scores(frame: DataFrame, scores: dict, label: str) -> DataFrame:
    """Rows per label, scored class and score value: the input of every AUC."""
    entries = F.array(
        *[
            F.struct(F.lit(c).cast("int").alias("cls"), F.col(name).cast("double").alias("score"))
            for c, name in scores.items()
        ]
    )
    return (
        frame.select(F.col(label).cast("int").alias("truth"), F.inline(entries))
        .groupBy("truth", "cls", "score")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _area(grouped: DataFrame, by: Sequence[str]) -> DataFrame:
    """AUC per group from positive and negative counts per score; ties count half."""
    ordered = running_totals(grouped, by, "score", ["pos", "neg"])
    above = F.col("total_pos") - F.col("before_pos") - F.col("pos")
    won = F.col("neg").cast("double") * (above + F.col("pos") / 2)
    return (
        ordered.groupBy(*by)
        .agg(
            F.sum(won).alias("won"),
            F.max("total_pos").cast("double").alias("p"),
            F.max("total_neg").cast("double").alias("n"),
        )
        .withColumn("auc", F.try_divide(F.col("won"), F.col("p") * F.col("n")))
    )


def roc_auc_by_class(frame: DataFrame, scores: dict, label: str = "label") -> DataFrame:
    """One-vs-rest AUC of every scored class."""
    counts = _class_scores(frame, scores, label)
    own = F.col("truth") == F.col("cls")
    grouped = counts.groupBy("cls", "score").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(own, F.lit(0)).otherwise(F.col("n"))).alias("neg"),
    )
    return _area(grouped, ["cls"]).select("cls", "auc")


def roc_auc_ovr(frame: DataFrame, scores: dict, label: str = "label") -> DataFrame:
    """Mean one-vs-rest AUC; no row when a scored class is absent from the truth."""
    areas = roc_auc_by_class(frame, scores, label)
    return (
        areas.agg(F.avg("auc").alias("roc_auc_ovr"), F.count("auc").alias("defined"))
        .filter(F.col("defined") == len(scores))
        .drop("defined")
    )


def hand_till_auc(frame: DataFrame, scores: dict, label: str = "label") -> DataFrame:
    """Multiclass AUC as the mean over class pairs (Hand and Till, 2001).

    Pairs are built from the counts per score, not from rows.
    """
    counts = _class_scores(frame, scores, label)
    classes = F.array(*[F.lit(c).cast("int") for c in scores])
    own = counts.filter("truth = cls").select(
        "cls", "score", F.explode(classes).alias("other"), F.col("n").alias("pos"),
        F.lit(0).cast("long").alias("neg"),
    ).filter("other <> cls")
    rest = counts.filter("truth <> cls").select(
        "cls", "score", F.col("truth").alias("other"), F.lit(0).cast("long").alias("pos"),
        F.col("n").alias("neg"),
    )
    grouped = (
        own.unionByName(rest)
        .groupBy("cls", "other", "score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    return _area(grouped, ["cls", "other"]).agg(F.avg("auc").alias("hand_till_auc"))


def agreement_report(
    frame: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and kappa, and per class the usual rates of a class against the rest."""
    classes = per_class(confusion_counts(frame, label, prediction))
    whole = classes.agg(
        F.sum("support").cast("double").alias("n"),
        F.sum("hits").cast("double").alias("hits"),
        F.sum(F.col("support").cast("double") * F.col("predicted")).alias("chance"),
    ).select(
        "n",
        (F.col("hits") / F.col("n")).alias("accuracy"),
        (F.col("chance") / (F.col("n") * F.col("n"))).alias("expected"),
    )
    facts = whole.select(
        F.struct(
            "n",
            "accuracy",
            F.try_divide(F.col("accuracy") - F.col("expected"), 1 - F.col("expected")).alias("kappa"),
        )
    ).scalar()
    negatives = F.col("n") - F.col("support")
    false_alarms = F.col("predicted") - F.col("hits")
    sensitivity = F.try_divide(F.col("hits"), F.col("support"))
    specificity = F.try_divide(negatives - false_alarms, negatives)
    return (
        classes.withColumn("facts", facts)
        .select("*", "facts.n", "facts.accuracy", "facts.kappa")
        .select(
            F.col("cls").alias("class"),
            "accuracy",
            "kappa",
            sensitivity.alias("sensitivity"),
            specificity.alias("specificity"),
            F.try_divide(F.col("hits"), F.col("predicted")).alias("positive_value"),
            F.try_divide(negatives - false_alarms, F.col("n") - F.col("predicted")).alias("negative_value"),
            F.try_divide(F.col("support"), F.col("n")).alias("prevalence"),
            ((sensitivity + specificity) / 2).alias("balanced_accuracy"),
        )
    )


def regression_metrics(
    frame: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: RMSE, MAE and R2 in log space, median absolute error in dollars."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    squared = (y - p) * (y - p)
    moments = frame.agg(
        F.sqrt(F.avg(squared)).alias("rmse_log"),
        F.avg(F.abs(y - p)).alias("mae_log"),
        (1 - F.try_divide(F.sum(squared), F.var_pop(y) * F.count(y))).alias("r2_log"),
    )
    dollars = median_dollar_error(frame, label, prediction).select("median_abs_dollar_error")
    return moments.withColumn("median_abs_dollar_error", dollars.scalar())


def median_dollar_error(
    frame: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    approximate: bool = False,
) -> DataFrame:
    """Median of the absolute dollar error of log-space predictions."""
    error = F.abs(F.exp(F.col(label)) - F.exp(F.col(prediction)))
    if approximate:
        return frame.agg(F.percentile_approx(error, 0.5, 10_000).alias("median_abs_dollar_error"))
    errors = frame.select(F.lit("error").alias("column_name"), error.alias("value"))
    return exact_quantiles(
        errors, ["column_name"], "value", {"median_abs_dollar_error": 0.5}
    ).drop("column_name")


def simple_regression(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Closed-form least squares with one feature."""
    # The built-ins take the dependent variable first.
    return frame.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def select_best(
    results: DataFrame, score: str = "selection_score", lowest: bool = False
) -> DataFrame:
    """The candidate with the best score; the first listed (``ordinal``) wins ties."""
    order = F.col(score).asc() if lowest else F.col(score).desc()
    return results.orderBy(order, "ordinal").limit(1)


def leaderboard(long: DataFrame, metrics: Sequence[str], winner: str) -> DataFrame:
    """One row per model, metrics as columns, and a flag on the production model."""
    wide = long.groupBy("model").pivot("metric", list(metrics)).agg(F.first("value"))
    return wide.withColumn("production", F.col("model") == F.lit(winner))


class MacroF1Evaluator(
    Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Unweighted mean F1 over the classes in truth or prediction."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        row = classification_metrics(dataset, self.getLabelCol(), self.getPredictionCol()).first()
        return float(row["macro_f1"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True
