"""Candidate tier classifiers and charge regressors on MLlib."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasSeed,
    HasWeightCol,
)
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import boosting
from claimloom.operators.encoders import build_preprocessor, feature_names
from claimloom.operators.forest import ForestClassifier, ForestRegressor
from claimloom.operators.knn import NeighbourClassifier

LABEL, WEIGHT = "label", "weight"


@dataclass(frozen=True)
class Sizes:
    """How much model is built; the defaults are the full settings."""

    neighbours: int = 5
    tree_depth: int = 12
    tree_leaf: int = 20
    forest_trees: int = 300
    forest_depth: int = 16
    forest_leaf: int = 5
    rounds: int = 400
    round_depth: int = 6
    rate: float = 0.1
    # Fewer bins than code frequencies would merge values before a tree sees them.
    max_bins: int = 256
    row_share: float = 0.9
    feature_share: str = "0.9"
    alpha: float = 1.0


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    maxIter = Param(Params._dummy(), "maxIter", "boosting rounds", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = Param(
        Params._dummy(), "subsamplingRate", "share of rows per tree", TypeConverters.toFloat
    )
    featureSubsetStrategy = Param(
        Params._dummy(), "featureSubsetStrategy", "features per split", TypeConverters.toString
    )
    minInstancesPerNode = Param(
        Params._dummy(), "minInstancesPerNode", "least rows per leaf", TypeConverters.toInt
    )
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    store = Param(
        Params._dummy(), "store", "folder that keeps trees while fitting; empty: none", TypeConverters.toString
    )


class _ClassParams(_BoostingParams, HasProbabilityCol, HasWeightCol):
    numClasses = Param(Params._dummy(), "numClasses", "number of classes", TypeConverters.toInt)


class BoostedClassifier(Estimator, _ClassParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for several classes with softmax (see ``boosting``).

    MLlib boosts two classes only. ``minInstancesPerNode`` is the least sum of curvature times weight in a
    child, and ``featureSubsetStrategy`` the share of features that a tree may split.
    """

    def __init__(self, **params):
        super().__init__()
        self._setDefault(
            numClasses=len(S.TIERS), maxIter=400, maxDepth=6, stepSize=0.1, subsamplingRate=0.9,
            featureSubsetStrategy="0.9", minInstancesPerNode=1, maxBins=256, seed=S.SEED, store="",
            labelCol=LABEL, featuresCol="features", predictionCol="prediction",
            probabilityCol="probability",
        )
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> "BoostedModel":
        get = self.getOrDefault
        weighted = self.isSet(self.weightCol) and self.getWeightCol() in dataset.columns
        settings = boosting.Settings(
            classes=get(self.numClasses), rounds=get(self.maxIter), depth=get(self.maxDepth), rate=get(self.stepSize),
            row_share=get(self.subsamplingRate), feature_share=float(get(self.featureSubsetStrategy)),
            least_weight=float(get(self.minInstancesPerNode)), max_bins=get(self.maxBins), seed=get(self.seed),
        )
        ensemble = boosting.fit(
            dataset, self.getFeaturesCol(), self.getLabelCol(), self.getWeightCol() if weighted else None, settings,
            get(self.store) or None,
        )
        fitted = BoostedModel(ensemble)
        fitted._set(
            numClasses=get(self.numClasses), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(), probabilityCol=self.getProbabilityCol(),
        )
        return fitted


class BoostedRegressor(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for a number (see ``boosting``), with the error, first tree and step of MLlib's ``GBTRegressor``.

    ``featureSubsetStrategy`` is the share of features that a node may split.
    """

    def __init__(self, **params):
        super().__init__()
        self._setDefault(
            maxIter=20, maxDepth=5, stepSize=0.1, subsamplingRate=1.0, featureSubsetStrategy="1.0", minInstancesPerNode=1,
            maxBins=32, seed=S.SEED, store="", labelCol=LABEL, featuresCol="features", predictionCol="prediction",
        )
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> "BoostedRegressionModel":
        get = self.getOrDefault
        settings = boosting.Settings(
            classes=0, rounds=get(self.maxIter), depth=get(self.maxDepth), rate=get(self.stepSize),
            row_share=get(self.subsamplingRate), feature_share=float(get(self.featureSubsetStrategy)),
            least_weight=float(get(self.minInstancesPerNode)), max_bins=get(self.maxBins), seed=get(self.seed),
        )
        ensemble = boosting.fit(
            dataset, self.getFeaturesCol(), self.getLabelCol(), None, settings, get(self.store) or None
        )
        fitted = BoostedRegressionModel(ensemble)
        fitted._set(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol())
        return fitted


class _BoostedWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        ensemble = self.instance.ensemble
        nodes = self.sparkSession.createDataFrame(ensemble.rows(), boosting.STORED)
        nodes.coalesce(1).write.parquet(f"{path}/nodes")
        edges = [(i, [float(v) for v in e]) for i, e in enumerate(ensemble.edges)]
        self.sparkSession.createDataFrame(edges, "feature int, edges array<double>").coalesce(1).write.parquet(f"{path}/edges")


class _BoostedReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "_Boosted":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        edges = self.sparkSession.read.parquet(f"{path}/edges").orderBy("feature").collect()
        nodes = self.sparkSession.read.parquet(f"{path}/nodes").collect()
        model = self.kind(boosting.Ensemble.of(nodes, [np.array(r["edges"]) for r in edges]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _Boosted(Model, _BoostingParams, MLReadable, MLWritable):
    """Fitted trees of all rounds."""

    def __init__(self, ensemble: boosting.Ensemble | None = None):
        super().__init__()
        self.ensemble = ensemble

    def write(self) -> _BoostedWriter:
        return _BoostedWriter(self)

    @classmethod
    def read(cls) -> _BoostedReader:
        return _BoostedReader(cls)

    @property
    def featureImportances(self):
        """Share of each feature in the gain of all splits."""
        return self.ensemble.importances()


class BoostedModel(_Boosted, _ClassParams):
    """Fitted trees of all classes."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.ensemble)
        classes = self.getOrDefault(self.numClasses)

        @F.pandas_udf("array<double>")
        def shares(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            margins = shared.value.margins(np.stack(vectors.to_numpy()))
            margins = margins if margins.shape[1] else np.zeros((len(vectors), classes))
            p = np.exp(margins - margins.max(axis=1, keepdims=True))
            return pd.Series(list(p / p.sum(axis=1, keepdims=True)))

        best = F.array_position(F.col("__shares"), F.array_max("__shares")) - 1
        return (
            dataset.withColumn("__shares", shares(vector_to_array(self.getFeaturesCol())))
            .withColumn(self.getProbabilityCol(), array_to_vector("__shares"))
            .withColumn(self.getPredictionCol(), best.cast("double"))
            .drop("__shares")
        )


class BoostedRegressionModel(_Boosted):
    """Fitted trees that add up to a number."""

    def nodes(self) -> DataFrame:
        """One row per node, in the form of ``boosting.STORED``."""
        return SparkSession.getActiveSession().createDataFrame(self.ensemble.rows(), boosting.STORED)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.ensemble)

        @F.pandas_udf("double")
        def number(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=float)
            return pd.Series(shared.value.margins(np.stack(vectors.to_numpy())).sum(axis=1))

        return dataset.withColumn(self.getPredictionCol(), number(vector_to_array(self.getFeaturesCol())))


def classifiers(sizes: Sizes = Sizes(), seed: int = S.SEED) -> dict[str, Estimator]:
    """The four tier classifiers, in listing order."""
    return {
        "knn": NeighbourClassifier(k=sizes.neighbours, labelCol=LABEL),
        "decision_tree": DecisionTreeClassifier(
            labelCol=LABEL, weightCol=WEIGHT, maxDepth=sizes.tree_depth,
            minInstancesPerNode=sizes.tree_leaf, maxBins=sizes.max_bins, seed=seed,
        ),
        "random_forest": ForestClassifier(
            labelCol=LABEL, weightCol=WEIGHT, numTrees=sizes.forest_trees,
            maxDepth=sizes.forest_depth, minInstancesPerNode=sizes.forest_leaf,
            featureSubsetStrategy="sqrt", maxBins=sizes.max_bins, seed=seed,
        ),
        "boosted_trees": BoostedClassifier(
            labelCol=LABEL, weightCol=WEIGHT, maxIter=sizes.rounds, maxDepth=sizes.round_depth,
            stepSize=sizes.rate, subsamplingRate=sizes.row_share,
            featureSubsetStrategy=sizes.feature_share, maxBins=sizes.max_bins, seed=seed,
        ),
    }


def regressors(
    rows: int, deviation: float = 1.0, sizes: Sizes = Sizes(), seed: int = S.SEED
) -> dict[str, Estimator]:
    """The four log-charge regressors for a training fold of ``rows`` rows.

    MLlib divides the squared error by twice the number of rows and scales the label
    by its population ``deviation``. A ridge penalty ``alpha`` on the plain sum of
    squares is therefore ``alpha * deviation / rows`` here.
    """
    target = S.LOG_TOTAL
    return {
        # The flag columns add up to one. A penalty far below any digit that matters makes
        # the normal equations solvable in one step.
        "linear_regression": LinearRegression(
            labelCol=target, regParam=1e-10, elasticNetParam=0.0, solver="normal"
        ),
        "ridge_regression": LinearRegression(
            labelCol=target, regParam=sizes.alpha * deviation / max(rows, 1), elasticNetParam=0.0,
            standardization=False,
        ),
        "random_forest_regressor": ForestRegressor(
            labelCol=target, numTrees=sizes.forest_trees, maxDepth=sizes.forest_depth,
            minInstancesPerNode=sizes.forest_leaf, featureSubsetStrategy="all",
            maxBins=sizes.max_bins, seed=seed,
        ),
        "boosted_regressor": BoostedRegressor(
            labelCol=target, maxIter=sizes.rounds, maxDepth=sizes.round_depth, stepSize=sizes.rate,
            subsamplingRate=sizes.row_share, featureSubsetStrategy=sizes.feature_share,
            maxBins=sizes.max_bins, seed=seed,
        ),
    }


def fitting_regressors(
    train: DataFrame, sizes: Sizes = Sizes(), seed: int = S.SEED
) -> dict[str, Estimator]:
    """The regressors with the penalty scaled to a training table."""
    facts = train.agg(
        F.count(S.LOG_TOTAL).alias("rows"), F.stddev_pop(S.LOG_TOTAL).alias("deviation")
    ).first()
    return regressors(facts["rows"], facts["deviation"] or 1.0, sizes, seed)


def as_pipeline(model: Estimator) -> Pipeline:
    """Preprocessing and model as one object that is saved and loaded together."""
    return Pipeline(stages=[build_preprocessor(), model])


def preprocessor_of(fitted: PipelineModel) -> PipelineModel:
    return fitted.stages[0]


def estimator_of(fitted: PipelineModel) -> Model:
    return fitted.stages[-1]


def feature_importance(fitted: PipelineModel) -> DataFrame | None:
    """Importances by feature name, largest first; ``None`` when the model has none."""
    model = estimator_of(fitted)
    importances = getattr(model, "featureImportances", None)
    if importances is None:
        return None
    values = importances.toArray() if hasattr(importances, "toArray") else importances
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.lit(float(v)).alias("importance"))
            for n, v in zip(feature_names(preprocessor_of(fitted)), values)
        ]
    )
    # One row per feature: the fitted vector, not data.
    spark = preprocessor_of(fitted).stages[0].table.sparkSession
    return spark.range(1).select(F.inline(pairs)).orderBy(F.desc("importance"), "feature")
