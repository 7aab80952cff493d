"""All registered queries."""

from claimloom.plans import (  # noqa: F401
    attribution_queries,
    drift_queries,
    feature_queries,
    ingest_queries,
    knn_queries,
    metric_queries,
    model_queries,
    quality_queries,
    report_queries,
)
from claimloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
