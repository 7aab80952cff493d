"""Registered model queries build whole models."""

import os

import pytest

import __spark_entry__ as entry
from claimloom.operators import tuning
from claimloom.plans import training

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


class Asked(Exception):
    """What a query asked for, raised before any model is fitted."""


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("forest_tier", {"numTrees": 300, "maxDepth": 16}),
        ("feature_importance", {"numTrees": 300, "maxDepth": 16}),
        ("forest_charge", {"numTrees": 300, "maxDepth": 16}),
        ("boosted_tier", {"maxIter": 400, "maxDepth": 6}),
        ("boosted_charge", {"maxIter": 400, "maxDepth": 6}),
    ],
)
def test_models_have_their_full_size(spark, monkeypatch, name, wanted):
    def fit(self, model):
        raise Asked(model)

    monkeypatch.setattr(training.Encoded, "fit", fit)
    with pytest.raises(Asked) as asked:
        entry.queries()[name](spark, FOLDER)
    model = asked.value.args[0]
    assert {k: model.getOrDefault(k) for k in wanted} == wanted


def test_tuning_draws_from_the_full_space(spark, monkeypatch):
    def draw(space, n, *rest):
        raise Asked(space, n)

    monkeypatch.setattr(tuning, "draw_settings", draw)
    with pytest.raises(Asked) as asked:
        entry.queries()["tuned_params"](spark, FOLDER)
    assert asked.value.args == (tuning.SEARCH_SPACES["random_forest"], 10)
