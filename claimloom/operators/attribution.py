"""Feature attributions for fitted models."""

from math import factorial

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom import settings as S
from claimloom.functions.skew import lookup_join
from claimloom.functions.storage import cut, spread
from claimloom.operators import tree_attribution
from claimloom.operators.candidates import estimator_of, preprocessor_of
from claimloom.operators.encoders import FEATURE_VECTOR, feature_names

# Every feature doubles the number of coalitions and triples the subsets written into the plan.
MAX_FEATURES = 9

# Different background vectors.
MAX_BACKGROUND = 2_000

# Pairs of a vector and a background row per task.
BLENDS_PER_TASK = 20_000

CONTRIBUTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("feature", T.StringType()),
            T.StructField("contribution", T.DoubleType()),
            T.StructField("direction", T.StringType()),
        ]
    )
)


def _coalition_shares(n: int) -> list[list[float]]:
    """Shapley weight of joining ``s`` others, among ``d`` features that matter."""
    return [
        [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)] for d in range(n + 1)
    ]


def _coalitions(n: int) -> Column:
    """For every set of features, as a bit mask, all of its subsets."""
    return F.array(
        *[
            F.array(*[F.lit(mask) for mask in range(2**n) if mask & ~players == 0])
            for players in range(2**n)
        ]
    )


def padded(shares: Column, classes: int) -> Column:
    """Class probabilities with zeros for top classes absent from training."""
    return F.array(*[F.coalesce(F.get(shares, F.lit(c)), F.lit(0.0)) for c in range(classes)])


def _output(model: Model, classes: int) -> Column:
    """Model output as an array: class probabilities, or the single prediction."""
    if "probabilityCol" in [p.name for p in model.params]:
        return padded(vector_to_array(model.getOrDefault("probabilityCol")), classes)
    return F.array(F.col(model.getOrDefault("predictionCol")))


def background_vectors(fitted: PipelineModel, background: DataFrame) -> list[tuple[list, float]]:
    """Distinct background vectors with their shares; all rows of the background count.

    They become part of the plan, so a background with very many different vectors is an
    error: draw a sample first (``splits.sample_rows``).
    """
    encoded = preprocessor_of(fitted).transform(background)
    rows = (
        encoded.groupBy(vector_to_array(FEATURE_VECTOR).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(MAX_BACKGROUND + 1)
        .collect()
    )
    if len(rows) > MAX_BACKGROUND:
        raise ValueError(f"more than {MAX_BACKGROUND} different background vectors; draw a sample")
    total = sum(r.n for r in rows)
    return sorted((list(r.b), r.n / total) for r in rows)


def shapley(
    fitted: PipelineModel, rows: DataFrame, background: DataFrame | None, classes: int
) -> DataFrame:
    """Exact Shapley values of every row's features, for each model output.

    A coalition takes its features from the row and the others from a background
    row. A feature that is equal in both changes nothing, so only coalitions of the
    features that differ are scored. Equal feature vectors are explained once. All
    blends of one vector are built and averaged inside one task, so only one row
    per vector is shuffled. Returns the rows with ``shap``: an array over features
    of arrays over outputs, and ``base``: the mean output over the background.
    """
    model = estimator_of(fitted)
    names = feature_names(preprocessor_of(fitted))
    n = len(names)
    if n > MAX_FEATURES:
        raise ValueError(f"{n} features are too many for exact coalitions")
    blends = [] if background is None else background_vectors(fitted, background)
    if not blends:
        raise ValueError("A background sample is needed to explain this model")
    encoded = preprocessor_of(fitted).transform(rows).withColumn("__x", vector_to_array(FEATURE_VECTOR))
    vectors = cut(encoded.select("__x").distinct())
    vectors = spread(vectors, vectors.count() * len(blends), BLENDS_PER_TASK)
    samples = F.array(
        *[
            F.struct(F.array(*[F.lit(v) for v in b]).alias("b"), F.lit(share).alias("share"))
            for b, share in blends
        ]
    )
    players = sum(
        F.when(F.col("__x")[i] != F.col("s.b")[i], F.lit(1 << i)).otherwise(F.lit(0)) for i in range(n)
    )
    pieces = [
        F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("__x")[i]).otherwise(F.col("s.b")[i])
        for i in range(n)
    ]
    blended = (
        vectors.select("__x", F.explode(samples).alias("s"))
        .withColumn("players", players)
        .select("*", F.explode(_coalitions(n)[F.col("players")]).alias("mask"))
        .select(
            "__x", "players", "mask", "s.share", array_to_vector(F.array(*pieces)).alias(FEATURE_VECTOR)
        )
    )
    shares = F.array(*[F.array(*[F.lit(w) for w in row]).cast("array<double>") for row in _coalition_shares(n)])
    scored = model.transform(blended).select(
        "players",
        "__x",
        "mask",
        "share",
        F.get(shares, F.bit_count("players")).alias("weights"),
        F.bit_count("mask").alias("size"),
        _output(model, classes).alias("out"),
    )

    def factor(i: int) -> Column:
        bit = F.lit(1 << i)
        joined = F.get("weights", F.col("size") - 1)
        apart = -F.get("weights", F.col("size"))
        return (
            F.when(F.col("players").bitwiseAND(bit) == 0, F.lit(0.0))
            .when(F.col("mask").bitwiseAND(bit) != 0, joined)
            .otherwise(apart)
        ) * F.col("share")

    scored = scored.select("__x", "mask", "share", "out", *[factor(i).alias(f"k_{i}") for i in range(n)])
    sums = [
        F.sum(F.col(f"k_{i}") * F.col("out")[c]).alias(f"phi_{i}_{c}")
        for i in range(n)
        for c in range(classes)
    ]
    bases = [
        F.sum(F.when(F.col("mask") == 0, F.col("share") * F.col("out")[c]).otherwise(0.0)).alias(f"base_{c}")
        for c in range(classes)
    ]
    values = scored.groupBy("__x").agg(*sums, *bases)
    shaped = values.select(
        "__x",
        F.array(*[F.array(*[F.col(f"phi_{i}_{c}") for c in range(classes)]) for i in range(n)]).alias("shap"),
        F.array(*[F.col(f"base_{c}") for c in range(classes)]).alias("base"),
    )
    temporary = [c for c in encoded.columns if c not in rows.columns]
    return lookup_join(encoded, cut(shaped), ["__x"], "left").drop(*temporary)


def linear_values(fitted: PipelineModel, rows: DataFrame, background: DataFrame) -> DataFrame:
    """Closed form for a linear model: coefficient times distance from the background's mean."""
    model = estimator_of(fitted)
    if not isinstance(model, LinearRegressionModel):
        raise ValueError("not a linear model")
    weights = [float(w) for w in model.coefficients]
    x = vector_to_array(FEATURE_VECTOR)
    found = preprocessor_of(fitted).transform(background).agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(len(weights))])
    means = list(found.first())
    if None in means:
        raise ValueError("A background sample is needed to explain this model")
    encoded = preprocessor_of(fitted).transform(rows)
    shap = F.array(*[F.array(F.lit(w) * (x[i] - F.lit(m))) for i, (w, m) in enumerate(zip(weights, means))])
    base = model.intercept + sum(w * m for w, m in zip(weights, means))
    temporary = [c for c in encoded.columns if c not in rows.columns]
    return encoded.withColumn("shap", shap).withColumn("base", F.array(F.lit(float(base)))).drop(*temporary)


def tree_shapley(
    fitted: PipelineModel, rows: DataFrame, background: DataFrame | None, classes: int
) -> DataFrame:
    """Exact Shapley values of a tree model's output, for any number of features.

    With a ``background`` the values of :func:`shapley`; without one, absent features follow the training
    rows through the trees. Equal feature vectors are explained once. Returns the rows with ``shap`` and ``base``.
    """
    names = feature_names(preprocessor_of(fitted))
    blends = None if background is None else background_vectors(fitted, background)
    if blends == []:
        raise ValueError("A background sample is needed to explain this model")
    encoded = preprocessor_of(fitted).transform(rows).withColumn("__x", vector_to_array(FEATURE_VECTOR))
    nodes = tree_attribution.model_nodes(estimator_of(fitted), classes)
    values = tree_attribution.tree_values(nodes, encoded.select("__x").distinct(), len(names), classes, blends)
    temporary = [c for c in encoded.columns if c not in rows.columns]
    return lookup_join(encoded, values, ["__x"], "left").drop(*temporary)


def explained(fitted: PipelineModel, rows: DataFrame, background: DataFrame | None, classes: int) -> DataFrame:
    """Shapley values by the way that fits the model: trees, linear, or coalitions for all others."""
    model = estimator_of(fitted)
    if tree_attribution.is_tree_model(model):
        return tree_shapley(fitted, rows, background, classes)
    if isinstance(model, LinearRegressionModel) and background is not None:
        return linear_values(fitted, rows, background)
    return shapley(fitted, rows, background, classes)


def top_contributions(
    names: list[str], contributions: Column, top_n: int | None = None
) -> Column:
    """The features with the largest absolute contribution, largest first.

    ``contributions`` is an array aligned with ``names``. Ties go by name.
    """
    entries = F.array(
        *[
            F.struct((-F.abs(contributions[i])).alias("order"), F.lit(n).alias("feature"),
                     contributions[i].alias("value"))
            for i, n in enumerate(names)
        ]
    )
    best = F.slice(F.array_sort(entries), 1, top_n or S.TOP_FEATURES)
    return F.transform(
        best,
        lambda e: F.struct(
            e["feature"].alias("feature"),
            F.round(e["value"], 6).alias("contribution"),
            F.when(e["value"] > 0, F.lit("increases")).otherwise(F.lit("decreases")).alias("direction"),
        ),
    )


def of_class(shap: Column, index: Column) -> Column:
    """One output's contributions; the last output when there are fewer."""
    return F.transform(shap, lambda f: F.get(f, F.least(index.cast("int"), F.size(f) - 1)))


def no_contributions() -> Column:
    return F.array().cast(CONTRIBUTIONS)


def impact_table(scored: DataFrame, key: str) -> DataFrame:
    """One row per explained feature, with the size of its effect."""
    return scored.select(key, F.inline("top_contributions")).withColumn("impact", F.abs("contribution"))


def probability_table(scored: DataFrame, key: str) -> DataFrame:
    """One row per tier with its probability."""
    return scored.select(key, F.explode("probabilities").alias("tier", "probability")).withColumn(
        "tier", F.concat(F.lit("Tier "), F.col("tier"))
    )
