"""Leaves weighed by patterns of their intervals."""

import numpy as np
import pyarrow as pa

from claimloom.operators import tree_attribution as ta


def _boxes(draw, leaves, features):
    rows = {name: [] for name in ("features", "low", "high", "absent", "values")}
    for _ in range(leaves):
        some = draw.permutation(features)[: draw.integers(0, features + 1)]
        edges = np.sort(draw.normal(size=(len(some), 2)) * 2, axis=1)
        rows["features"].append(some.tolist())
        rows["low"].append(edges[:, 0].tolist())
        rows["high"].append(edges[:, 1].tolist())
        rows["absent"].append([0.5] * len(some))
        rows["values"].append(draw.random(3).tolist())
    return ta.Boxes(pa.table(rows), features)


def test_patterns_give_the_values_of_all_background_rows():
    """One table per leaf instead of a pass over the background for each row."""
    draw = np.random.default_rng(1)
    boxes = _boxes(draw, 60, 6)
    shares = draw.random(40)
    background = [(b.tolist(), s / shares.sum()) for b, s in zip(draw.normal(size=(40, 6)), shares)]
    x = draw.normal(size=(70, 6))
    x[0, 2] = np.nan
    values, mean = ta.against_patterns(boxes, background, ta._pattern_weights(boxes.features.shape[1]))
    expected, base = ta.against_background(boxes, x, background)
    assert np.allclose(values(x), expected, atol=1e-12) and np.allclose(mean, base)
    assert np.abs(expected).max() > 0.01
