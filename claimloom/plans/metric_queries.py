"""Queries over metrics of a rule-based prediction, and over labelled documents."""

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import metrics
from claimloom.plans.registry import query
from claimloom.plans.sql import MODELING, SCORES

SCORE_COLUMNS = {t: f"p{t}" for t in S.TIERS}

_PER_CLASS = f"""{SCORES},
cells AS (SELECT label AS truth, prediction AS guess, count(*) AS n FROM scores GROUP BY 1, 2),
classes AS (SELECT truth AS cls FROM cells UNION SELECT guess FROM cells),
per_class AS (
  SELECT cls, coalesce((SELECT sum(n) FROM cells WHERE truth = cls), 0) AS support,
         coalesce((SELECT sum(n) FROM cells WHERE guess = cls), 0) AS predicted,
         coalesce((SELECT sum(n) FROM cells WHERE truth = cls AND guess = cls), 0) AS hits FROM classes),
f AS (SELECT *, 2.0 * hits / (support + predicted) AS f1 FROM per_class),
row_metrics AS (
  SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, avg(f1) AS macro_f1,
         sum(f1 * support) / sum(support) AS weighted_f1 FROM f)
"""


@query(
    "confusion_matrix",
    f"WITH {SCORES}, truths AS (SELECT unnest([1,2,3,4,5]) AS t) SELECT concat('true_', t) AS truth, "
    + ", ".join(f"count(*) FILTER (WHERE prediction = {p}) AS pred_{p}" for p in S.TIERS)
    + " FROM truths LEFT JOIN scores ON label = t GROUP BY t",
)
def confusion_matrix(t):
    return metrics.confusion_matrix(t.rule_scores(), S.TIERS)


def _metric(name: str):
    @query(name, f"WITH {_PER_CLASS} SELECT round({name}, 6) AS {name} FROM row_metrics")
    def build(t):
        row = metrics.classification_metrics(t.rule_scores())
        return row.select(F.round(name, 6).alias(name))


for _name in ("accuracy", "macro_f1", "weighted_f1"):
    _metric(_name)


@query(
    "selection_score",
    f"WITH {_PER_CLASS} SELECT round(0.6 * macro_f1 + 0.4 * accuracy, 6) AS selection_score FROM row_metrics",
)
def selection_score(t):
    return metrics.classification_metrics(t.rule_scores()).select(
        F.round("selection_score", 6).alias("selection_score")
    )


_LONG = f"""{SCORES},
scored AS ({" UNION ALL ".join(
    f"SELECT label AS truth, {c} AS cls, p{c} AS score FROM scores" for c in S.TIERS)})
"""


@query(
    "score_running_counts",
    f"""WITH {_LONG}, grouped AS (SELECT cls, score, count(*) FILTER (WHERE truth = cls) AS pos,
        count(*) FILTER (WHERE truth <> cls) AS neg FROM scored GROUP BY 1, 2)
    SELECT cls, score, pos, neg,
      CAST(sum(pos) OVER w - pos AS BIGINT) AS before_pos, CAST(sum(neg) OVER w - neg AS BIGINT) AS before_neg
    FROM grouped WINDOW w AS (PARTITION BY cls ORDER BY score)""",
)
def score_running_counts(t):
    from claimloom.functions.ranks import running_totals

    counts = metrics._class_scores(t.rule_scores(), SCORE_COLUMNS, "label")
    own = F.col("truth") == F.col("cls")
    grouped = counts.groupBy("cls", "score").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(own, F.lit(0)).otherwise(F.col("n"))).alias("neg"),
    )
    return running_totals(grouped, ["cls"], "score", ["pos", "neg"]).select(
        "cls", "score", "pos", "neg", "before_pos", "before_neg"
    )


@query(
    "roc_auc_ovr",
    f"""WITH {_LONG}, ranked AS (
      SELECT cls, truth = cls AS own,
        rank() OVER (PARTITION BY cls ORDER BY score)
          + (count(*) OVER (PARTITION BY cls, score) - 1) / 2.0 AS r FROM scored),
    sums AS (SELECT cls, CAST(sum(r) FILTER (WHERE own) AS DOUBLE) AS r, count(*) FILTER (WHERE own) AS p,
      count(*) FILTER (WHERE NOT own) AS n FROM ranked GROUP BY 1)
    SELECT round(avg((r - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n)), 6) AS roc_auc_ovr FROM sums""",
)
def roc_auc_ovr(t):
    return metrics.roc_auc_ovr(t.rule_scores(), SCORE_COLUMNS).select(
        F.round("roc_auc_ovr", 6).alias("roc_auc_ovr")
    )


@query(
    "hand_till_auc",
    f"""WITH {_LONG}, pairs AS (
      SELECT s.cls, o.other, s.truth = s.cls AS own, s.score
      FROM scored s JOIN (SELECT unnest([1,2,3,4,5]) AS other) o
        ON s.cls <> o.other AND s.truth IN (s.cls, o.other)),
    ranked AS (SELECT cls, other, own, rank() OVER (PARTITION BY cls, other ORDER BY score)
      + (count(*) OVER (PARTITION BY cls, other, score) - 1) / 2.0 AS r FROM pairs),
    sums AS (SELECT cls, other, CAST(sum(r) FILTER (WHERE own) AS DOUBLE) AS r,
      count(*) FILTER (WHERE own) AS p, count(*) FILTER (WHERE NOT own) AS n FROM ranked GROUP BY 1, 2)
    SELECT round(avg((r - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n)), 6) AS hand_till_auc FROM sums""",
)
def hand_till_auc(t):
    return metrics.hand_till_auc(t.rule_scores(), SCORE_COLUMNS).select(
        F.round("hand_till_auc", 6).alias("hand_till_auc")
    )


@query(
    "kappa_report",
    f"""WITH {_PER_CLASS}, whole AS (SELECT CAST(sum(support) AS DOUBLE) AS n,
      sum(CAST(support AS DOUBLE) * predicted) AS chance FROM per_class)
    SELECT cls AS class, round(accuracy, 6) AS accuracy,
      round((accuracy - chance / (n * n)) / (1 - chance / (n * n)), 6) AS kappa,
      round(CAST(hits AS DOUBLE) / nullif(support, 0), 6) AS sensitivity,
      round((n - support - (predicted - hits)) / nullif(n - support, 0), 6) AS specificity,
      round(CAST(hits AS DOUBLE) / nullif(predicted, 0), 6) AS positive_value,
      round((n - support - (predicted - hits)) / nullif(n - predicted, 0), 6) AS negative_value,
      round(support / n, 6) AS prevalence,
      round((CAST(hits AS DOUBLE) / nullif(support, 0)
        + (n - support - (predicted - hits)) / nullif(n - support, 0)) / 2, 6) AS balanced_accuracy
    FROM per_class, whole, row_metrics""",
)
def kappa_report(t):
    report = metrics.agreement_report(t.rule_scores())
    numbers = [c for c in report.columns if c != "class"]
    return report.select("class", *[F.round(c, 6).alias(c) for c in numbers])


@query(
    "regression_metrics",
    f"""WITH {SCORES}, e AS (SELECT LOG_TOTAL_CHARGE AS y, predicted_log AS p FROM scores)
    SELECT round(sqrt(avg((y-p)*(y-p))), 6) AS rmse_log, round(avg(abs(y-p)), 6) AS mae_log,
      round(1 - sum((y-p)*(y-p)) / (var_pop(y) * count(y)), 6) AS r2_log,
      round(median(abs(exp(y)-exp(p))), 4) AS median_abs_dollar_error FROM e""",
)
def regression_metrics(t):
    row = metrics.regression_metrics(t.rule_scores(), S.LOG_TOTAL, "predicted_log")
    return row.select(
        *[F.round(c, 6).alias(c) for c in ("rmse_log", "mae_log", "r2_log")],
        F.round("median_abs_dollar_error", 4).alias("median_abs_dollar_error"),
    )


@query(
    "median_dollar_error",
    f"""WITH {SCORES} SELECT round(median(abs(exp(LOG_TOTAL_CHARGE) - exp(predicted_log))), 4)
      AS median_abs_dollar_error FROM scores""",
)
def median_dollar_error(t):
    row = metrics.median_dollar_error(t.rule_scores(), S.LOG_TOTAL, "predicted_log")
    return row.select(F.round("median_abs_dollar_error", 4).alias("median_abs_dollar_error"))


@query(
    "simple_ols",
    f"""WITH {MODELING} SELECT round(regr_slope(LOG_TOTAL_CHARGE, Number_of_Claims_inp), 6) AS slope,
      round(regr_intercept(LOG_TOTAL_CHARGE, Number_of_Claims_inp), 6) AS intercept,
      round(regr_r2(LOG_TOTAL_CHARGE, Number_of_Claims_inp), 6) AS r2 FROM model_rows""",
)
def simple_ols(t):
    fit = metrics.simple_regression(t.model_rows(), "Number_of_Claims_inp", S.LOG_TOTAL)
    return fit.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")])


# Three rule-based candidates: inpatient charge, outpatient charge, always tier 3.
_CANDIDATES = f"""{SCORES},
preds AS (
  SELECT 0 AS ordinal, 'inpatient_rule' AS model, label, prediction FROM scores
  UNION ALL SELECT 1, 'outpatient_rule', label, CASE WHEN CLM_TOT_CHRG_AMT_out <= 1000 THEN 1
    WHEN CLM_TOT_CHRG_AMT_out <= 10000 THEN 2 WHEN CLM_TOT_CHRG_AMT_out <= 100000 THEN 3
    WHEN CLM_TOT_CHRG_AMT_out <= 1000000 THEN 4 ELSE 5 END FROM scores
  UNION ALL SELECT 2, 'constant_rule', label, 3 FROM scores),
cells AS (SELECT ordinal, model, label AS truth, prediction AS guess, count(*) AS n FROM preds GROUP BY ALL),
classes AS (SELECT ordinal, model, truth AS cls FROM cells UNION SELECT ordinal, model, guess FROM cells),
f AS (SELECT c.ordinal, c.model, cls,
    (SELECT coalesce(sum(n),0) FROM cells x WHERE x.model=c.model AND truth=cls) AS support,
    (SELECT coalesce(sum(n),0) FROM cells x WHERE x.model=c.model AND guess=cls) AS predicted,
    (SELECT coalesce(sum(n),0) FROM cells x WHERE x.model=c.model AND truth=cls AND guess=cls) AS hits
  FROM classes c),
results AS (SELECT ordinal, model, CAST(sum(hits) AS DOUBLE)/sum(support) AS accuracy,
    avg(2.0*hits/(support+predicted)) AS macro_f1 FROM f GROUP BY 1, 2),
ranked AS (SELECT *, 0.6*macro_f1 + 0.4*accuracy AS selection_score FROM results)
"""


def _candidate_results(t):
    from claimloom.functions import clean

    scores = t.rule_scores()
    guesses = {
        "inpatient_rule": F.col("prediction"),
        "outpatient_rule": clean.tier_of(F.col(S.CHARGE_OUT)),
        "constant_rule": F.lit(3),
    }
    rows = None
    for i, (name, guess) in enumerate(guesses.items()):
        row = metrics.classification_metrics(scores.withColumn("guess", guess), "label", "guess").select(
            F.lit(i).alias("ordinal"), F.lit(name).alias("model"), "accuracy", "macro_f1", "selection_score"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "select_best",
    f"""WITH {_CANDIDATES} SELECT model, round(selection_score, 6) AS selection_score FROM ranked
    ORDER BY ranked.selection_score DESC, ordinal LIMIT 1""",
)
def select_best(t):
    best = metrics.select_best(_candidate_results(t))
    return best.select("model", F.round("selection_score", 6).alias("selection_score"))


@query(
    "leaderboard",
    f"""WITH {_CANDIDATES} SELECT model, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
      round(selection_score, 6) AS selection_score,
      row_number() OVER (ORDER BY selection_score DESC, ordinal) = 1 AS production FROM ranked""",
)
def leaderboard(t):
    names = ["accuracy", "macro_f1", "selection_score"]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])
    long = _candidate_results(t).select("model", F.inline(pairs))
    winner = metrics.select_best(_candidate_results(t)).first()["model"]
    board = metrics.leaderboard(long, names, winner)
    return board.select("model", *[F.round(c, 6).alias(c) for c in names], "production")


_LABELS = """docs AS (SELECT doc_id, quality, toxic, n_chars, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS guess
  FROM labels JOIN documents USING (doc_id))"""


def _labelled(t):
    docs = t.read("documents").select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") > 2000, F.lit(1)).otherwise(F.lit(0))
    return t.read("labels").join(docs, "doc_id").withColumn("guess", guess)


@query(
    "label_confusion",
    f"""WITH {_LABELS} SELECT concat('true_', q) AS truth, count(*) FILTER (WHERE guess = 0) AS pred_0,
      count(*) FILTER (WHERE guess = 1) AS pred_1 FROM (SELECT unnest([0,1]) AS q) LEFT JOIN docs ON quality = q
    GROUP BY q""",
)
def label_confusion(t):
    return metrics.confusion_matrix(_labelled(t), [0, 1], "quality", "guess")


@query(
    "label_auc",
    f"""WITH {_LABELS}, ranked AS (SELECT quality, rank() OVER (ORDER BY n_chars)
        + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM docs)
    SELECT 1 AS cls, round((CAST(sum(r) FILTER (WHERE quality = 1) AS DOUBLE)
        - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0)
      / (CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) * count(*) FILTER (WHERE quality = 0)), 6) AS auc
    FROM ranked""",
)
def label_auc(t):
    areas = metrics.roc_auc_by_class(_labelled(t), {1: "n_chars"}, "quality")
    return areas.select("cls", F.round("auc", 6).alias("auc"))
