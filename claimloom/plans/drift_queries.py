"""Queries over drift of features, of rule-based predictions and of event windows."""

from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.operators import drift
from claimloom.plans.registry import query
from claimloom.plans.sql import FOLDS

TEXTS = [*S.CODE_COLUMNS, S.FLAG_COLUMN]


def _stack(source: str, columns, kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS {kind}) AS value FROM {source}" for c in columns
    )


def _numeric_sql(columns, ref: str, cur: str) -> str:
    return f"""
r AS ({_stack(ref, columns, 'DOUBLE')}), c AS ({_stack(cur, columns, 'DOUBLE')}),
counts AS (SELECT column_name, value, sum(a) AS a, sum(b) AS b FROM (
    SELECT column_name, value, 1 AS a, 0 AS b FROM r UNION ALL SELECT column_name, value, 0, 1 FROM c)
  GROUP BY 1, 2),
steps AS (SELECT column_name, value, lead(value) OVER w AS nxt,
    abs(sum(a) OVER w / CAST(sum(a) OVER (PARTITION BY column_name) AS DOUBLE)
      - sum(b) OVER w / CAST(sum(b) OVER (PARTITION BY column_name) AS DOUBLE)) AS gap
  FROM counts WINDOW w AS (PARTITION BY column_name ORDER BY value)),
spread AS (SELECT column_name, greatest(stddev_pop(value), 0.001) AS deviation FROM r GROUP BY 1),
numeric_scores AS (SELECT column_name, coalesce(sum(gap * (nxt - value)), 0) / max(deviation) AS wasserstein,
    max(gap) AS ks FROM steps JOIN spread USING (column_name) GROUP BY 1)
"""


def _text_sql(columns, ref: str, cur: str) -> str:
    return f"""
tr AS ({_stack(ref, columns, 'VARCHAR')}), tc AS ({_stack(cur, columns, 'VARCHAR')}),
rf AS (SELECT column_name, value, count(*) AS n,
         sum(count(*)) OVER (PARTITION BY column_name) AS total FROM tr GROUP BY 1, 2),
cf AS (SELECT column_name, value, count(*) AS n,
         sum(count(*)) OVER (PARTITION BY column_name) AS total FROM tc GROUP BY 1, 2),
rt AS (SELECT column_name, max(total) AS rn FROM rf GROUP BY 1),
ct AS (SELECT column_name, max(total) AS cn FROM cf GROUP BY 1),
cells AS (SELECT column_name, value, coalesce(rf.n, 0) AS a, coalesce(cf.n, 0) AS b,
    CAST(rn AS DOUBLE) AS rn, CAST(cn AS DOUBLE) AS cn, coalesce(rf.n, 0) / CAST(rn AS DOUBLE) AS p,
    coalesce(cf.n, 0) / CAST(cn AS DOUBLE) AS q
  FROM rf FULL JOIN cf USING (column_name, value) JOIN rt USING (column_name) JOIN ct USING (column_name)),
text_scores AS (SELECT column_name,
    sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * log2(2*p/(p+q)) ELSE 0 END
           + 0.5 * CASE WHEN q > 0 THEN q * log2(2*q/(p+q)) ELSE 0 END), 0)) AS jensen_shannon,
    sum(pow(a - rn*(a+b)/(rn+cn), 2) / (rn*(a+b)/(rn+cn)) + pow(b - cn*(a+b)/(rn+cn), 2) / (cn*(a+b)/(rn+cn)))
      AS chi_square,
    sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))) AS psi
  FROM cells GROUP BY 1)
"""


def _feature_folds(t):
    train, test = t.train_test()
    return clean.feature_frame(train), clean.feature_frame(test)


@query(
    "feature_drift_numeric",
    f"""WITH {FOLDS}, {_numeric_sql(S.NUMERIC_COLUMNS, 'train', 'test')}
    SELECT column_name, round(wasserstein, 6) AS wasserstein, round(ks, 6) AS ks FROM numeric_scores""",
)
def feature_drift_numeric(t):
    scores = drift.numeric_drift(*_feature_folds(t), S.NUMERIC_COLUMNS)
    return scores.select("column_name", F.round("wasserstein", 6).alias("wasserstein"),
                         F.round("ks", 6).alias("ks"))


@query(
    "feature_drift_categorical",
    f"""WITH {FOLDS}, {_text_sql(TEXTS, 'train', 'test')}
    SELECT column_name, round(jensen_shannon, 6) AS jensen_shannon, round(chi_square, 4) AS chi_square,
      round(psi, 6) AS psi FROM text_scores""",
)
def feature_drift_categorical(t):
    scores = drift.categorical_drift(*_feature_folds(t), TEXTS)
    return scores.select("column_name", F.round("jensen_shannon", 6).alias("jensen_shannon"),
                         F.round("chi_square", 4).alias("chi_square"), F.round("psi", 6).alias("psi"))


_BOTH = f"""{FOLDS}, {_numeric_sql(S.NUMERIC_COLUMNS, 'train', 'test')},
{_text_sql(TEXTS, 'train', 'test')},
column_scores AS (SELECT column_name, 'wasserstein' AS statistic, wasserstein AS score FROM numeric_scores
  UNION ALL SELECT column_name, 'jensen_shannon', jensen_shannon FROM text_scores)
"""


@query(
    "drift_column_scores",
    f"""WITH {_BOTH} SELECT column_name, statistic, round(score, 6) AS score, score >= 0.1 AS drifted
    FROM column_scores""",
)
def drift_column_scores(t):
    train, test = _feature_folds(t)
    numeric, texts = drift.column_roles(train)
    scores = drift.column_scores(train, test, numeric, texts)
    return scores.withColumn("score", F.round("score", 6))


@query(
    "drift_summary",
    f"""WITH {_BOTH} SELECT count(*) FILTER (WHERE score >= 0.1) AS drifted_columns, count(*) AS columns,
      round(avg(CASE WHEN score >= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS drifted_share FROM column_scores""",
)
def drift_summary(t):
    train, test = _feature_folds(t)
    numeric, texts = drift.column_roles(train)
    summary = drift.summarise(drift.column_scores(train, test, numeric, texts))
    return summary.withColumn("drifted_share", F.round("drifted_share", 6))


_RULE = """CASE WHEN CLM_TOT_CHRG_AMT_inp <= 1000 THEN 1 WHEN CLM_TOT_CHRG_AMT_inp <= 10000 THEN 2
  WHEN CLM_TOT_CHRG_AMT_inp <= 100000 THEN 3 WHEN CLM_TOT_CHRG_AMT_inp <= 1000000 THEN 4 ELSE 5 END"""


@query(
    "rule_prediction_drift",
    f"""WITH {FOLDS}, ptrain AS (SELECT {_RULE} AS predicted_tier FROM train),
    ptest AS (SELECT {_RULE} AS predicted_tier FROM test),
    {_numeric_sql(['predicted_tier'], 'ptrain', 'ptest')},
    {_text_sql(['predicted_tier'], 'ptrain', 'ptest')}
    SELECT column_name, round(wasserstein, 6) AS wasserstein, round(jensen_shannon, 6) AS jensen_shannon
    FROM numeric_scores JOIN text_scores USING (column_name)""",
)
def rule_prediction_drift(t):
    tier = clean.tier_of(F.col(S.CHARGE_INP)).alias("predicted_tier")
    train, test = (rows.select(tier) for rows in t.train_test())
    numeric = drift.numeric_drift(train, test, ["predicted_tier"])
    texts = drift.categorical_drift(train, test, ["predicted_tier"])
    return numeric.join(texts, "column_name").select(
        "column_name", F.round("wasserstein", 6).alias("wasserstein"),
        F.round("jensen_shannon", 6).alias("jensen_shannon"),
    )


@query(
    "document_drift",
    f"""WITH english AS (SELECT source, n_chars FROM documents WHERE lang = 'en'),
    other AS (SELECT source, n_chars FROM documents WHERE lang <> 'en'),
    {_numeric_sql(['n_chars'], 'english', 'other')}, {_text_sql(['source'], 'english', 'other')}
    SELECT column_name, 'wasserstein' AS statistic, round(wasserstein, 6) AS score,
      wasserstein >= 0.1 AS drifted FROM numeric_scores
    UNION ALL SELECT column_name, 'jensen_shannon', round(jensen_shannon, 6), jensen_shannon >= 0.1
    FROM text_scores""",
)
def document_drift(t):
    docs = t.read("documents").select("lang", "source", "n_chars")
    english, other = docs.filter("lang = 'en'").drop("lang"), docs.filter("lang <> 'en'").drop("lang")
    scores = drift.column_scores(english, other, ["n_chars"], ["source"])
    return scores.withColumn("score", F.round("score", 6))


@query(
    "windowed_drift",
    """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, value FROM events),
    ref AS (SELECT * FROM e WHERE day < '2024-01-08'), cur AS (SELECT * FROM e WHERE day >= '2024-01-08'),
    edges AS (SELECT unnest([quantile_cont(value, 0.1), quantile_cont(value, 0.2), quantile_cont(value, 0.3),
      quantile_cont(value, 0.4), quantile_cont(value, 0.5), quantile_cont(value, 0.6),
      quantile_cont(value, 0.7), quantile_cont(value, 0.8), quantile_cont(value, 0.9)]) AS edge FROM ref),
    r AS (SELECT 'event_type' AS column_name, event_type AS value FROM ref UNION ALL
      SELECT 'value', CAST((SELECT count(*) FROM edges WHERE edge < ref.value) AS VARCHAR) FROM ref),
    c AS (SELECT day, 'event_type' AS column_name, event_type AS value FROM cur UNION ALL
      SELECT day, 'value', CAST((SELECT count(*) FROM edges WHERE edge < cur.value) AS VARCHAR) FROM cur),
    p AS (SELECT column_name, value, count(*) / CAST(sum(count(*)) OVER (PARTITION BY column_name) AS DOUBLE)
      AS p FROM r GROUP BY 1, 2),
    days AS (SELECT day, column_name, count(*) AS rows FROM c GROUP BY 1, 2),
    n AS (SELECT day, column_name, value, count(*) AS k FROM c GROUP BY 1, 2, 3),
    vals AS (SELECT column_name, value FROM p UNION SELECT column_name, value FROM n),
    cells AS (SELECT d.day, d.column_name, d.rows, coalesce(p.p, 0) AS p, coalesce(n.k, 0) / CAST(d.rows AS DOUBLE) AS q
      FROM days d JOIN vals v USING (column_name) LEFT JOIN p ON p.column_name = v.column_name AND p.value = v.value
      LEFT JOIN n ON n.day = d.day AND n.column_name = v.column_name AND n.value = v.value)
    SELECT day, column_name, max(rows) AS rows,
      round(sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * log2(2*p/(p+q)) ELSE 0 END
        + 0.5 * CASE WHEN q > 0 THEN q * log2(2*q/(p+q)) ELSE 0 END), 0)), 6) AS jensen_shannon
    FROM cells GROUP BY 1, 2""",
)
def windowed_drift(t):
    events = t.read("events").select(
        F.date_format(F.window("ts", "1 day").start, "yyyy-MM-dd").alias("day"), "event_type", "value"
    )
    reference = events.filter("day < '2024-01-08'")
    current = events.filter("day >= '2024-01-08'")
    edges = {"value": drift.reference_bins(reference, "value")}
    scores = drift.batch_drift(reference, current, "day", ["event_type"], edges)
    return scores.withColumn("jensen_shannon", F.round("jensen_shannon", 6))
