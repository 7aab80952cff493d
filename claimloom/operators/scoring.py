"""Scoring jobs over whole tables."""

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.operators import attribution
from claimloom.operators.candidates import preprocessor_of
from claimloom.operators.encoders import feature_names


@dataclass
class Bundle:
    """Fitted models with what is needed to describe and explain their scores."""

    classifier: PipelineModel
    regressor: PipelineModel
    metadata: dict = field(default_factory=dict)
    background: DataFrame | None = None

    @property
    def classifier_name(self) -> str:
        return self.metadata["classifier"]

    @property
    def regressor_name(self) -> str:
        return self.metadata["regressor"]


def _scored(model: PipelineModel, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    scored = model.transform(rows)
    return scored, [c for c in scored.columns if c not in rows.columns]


def predict_tier(bundle: Bundle, rows: DataFrame, explain: bool = True) -> DataFrame:
    """Tier, description, confidence, probabilities, contributions and model name.

    Without a background sample the contributions are empty; the prediction stays.
    """
    if explain and bundle.background is not None:
        rows = attribution.explained(bundle.classifier, rows, bundle.background, len(S.TIERS))
        names = feature_names(preprocessor_of(bundle.classifier))
        contributions = attribution.top_contributions(
            names, attribution.of_class(F.col("shap"), F.col("prediction"))
        )
        temporary = ["shap", "base"]
    else:
        contributions, temporary = attribution.no_contributions(), []
    scored, added = _scored(bundle.classifier, rows)
    shares = attribution.padded(vector_to_array("probability"), len(S.TIERS))
    labels = F.array(*[F.lit(str(t)) for t in S.TIERS])
    tier = clean.to_tier(F.col("prediction"))
    results = {
        "tier": tier,
        "tier_description": clean.tier_description(tier),
        "confidence": F.get(shares, F.col("prediction").cast("int")),
        "probabilities": F.map_from_arrays(labels, shares),
        "top_contributions": contributions,
        "model_name": F.lit(bundle.classifier_name),
    }
    return scored.withColumns(results).drop(*added, *temporary)


def predict_charge(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """Predicted charge in dollars and in log space, and the model name."""
    scored, added = _scored(bundle.regressor, rows)
    results = {
        "predicted_charge": clean.to_dollars(F.col("prediction")),
        "predicted_log_charge": F.col("prediction"),
        "model_name": F.lit(bundle.regressor_name),
    }
    return scored.withColumns(results).drop(*added)
