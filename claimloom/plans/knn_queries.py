"""Nearest-neighbour queries over embeddings and claims features."""

from pyspark.sql import functions as F

from claimloom.operators import knn
from claimloom.plans.registry import query

_PAIRS = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
ranked AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, a.label AS truth, b.label,
    round(list_distance(a.v, b.v), 9) AS distance,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id) AS rank
  FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


def _vectors(t):
    return t.read("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


@query(
    "knn_join",
    f"WITH {_PAIRS} SELECT id, neighbour, round(distance, 6) AS distance, rank FROM ranked WHERE rank <= 5",
)
def knn_join(t):
    rows = _vectors(t)
    near = knn.knn_join(rows, rows, 5, exclude_self=True)
    return near.select("id", "neighbour", F.round("distance", 6).alias("distance"), "rank")


@query(
    "knn_vote",
    f"""WITH {_PAIRS}, w AS (SELECT id, label, sum(CASE WHEN distance = 0 THEN 1e300 ELSE 1 / distance END) AS w
      FROM ranked WHERE rank <= 5 GROUP BY 1, 2),
    best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(w, 9) DESC, label) AS r,
      sum(w) OVER (PARTITION BY id) AS total FROM w)
    SELECT id, label AS prediction, round(w / total, 6) AS confidence FROM best WHERE r = 1""",
)
def knn_vote(t):
    rows = _vectors(t)
    near = knn.knn_join(rows, rows, 5, exclude_self=True, carry="label")
    votes = knn.vote(near, list(range(10)))
    return votes.select("id", "prediction", F.round(F.array_max("shares"), 6).alias("confidence"))


@query(
    "knn_k_grid",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
        CAST(('0x' || substr(md5(concat(CAST(vec_id AS VARCHAR), ':42')), 1, 8)) AS BIGINT) % 5 AS fold
      FROM embeddings),
    ranked AS (SELECT a.vec_id AS id, a.label AS truth, b.label,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id) AS rank
      FROM e a JOIN e b ON a.fold <> b.fold),
    ks AS (SELECT unnest([3,5,7,9,11]) AS k),
    votes AS (SELECT k, id, any_value(truth) AS truth, label, count(*) AS n FROM ranked JOIN ks ON rank <= k
      GROUP BY k, id, label),
    best AS (SELECT *, row_number() OVER (PARTITION BY k, id ORDER BY n DESC, label) AS r FROM votes)
    SELECT k, round(avg(CASE WHEN label = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM best WHERE r = 1
    GROUP BY k""",
)
def knn_k_grid(t):
    scores = knn.k_grid(_vectors(t), list(range(10)), [3, 5, 7, 9, 11])
    return scores.withColumn("accuracy", F.round("accuracy", 6))


@query("approximate_knn")
def approximate_knn(t):
    """Neighbours by random projections, k = 10, for all rows; a test measures recall against the exact join."""
    rows = _vectors(t)
    near = knn.approximate_knn_join(rows, rows, 10, exclude_self=True)
    return near.select("id", "neighbour", F.round("distance", 6).alias("distance"), "rank")
