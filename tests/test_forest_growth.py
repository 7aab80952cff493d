"""Growth of large nodes inside a task."""

import numpy as np
import pytest

from claimloom.operators import forest


def _rows(classes, rows=4000):
    draw = np.random.default_rng(7)
    x = np.column_stack([draw.integers(0, 40, rows), draw.integers(0, 200, rows), draw.integers(0, 2, rows), draw.integers(0, 90, rows)])
    y = (x[:, 0] > 17).astype(int) + (x[:, 1] > 120) + draw.integers(0, 10, rows) // 9
    w = 1.0 + y if classes else np.ones(rows)
    edges = [np.arange(int(x[:, i].max())) + 0.0 for i in range(4)]
    s = forest.Settings(1, 9, 3, "0.5", 1, classes, edges)
    return x.astype(np.uint8), y if classes else y + draw.random(rows), w, draw.integers(1, 4, rows).astype(float), s


def _numbered(nodes, root):
    number = np.full(len(nodes["left"]), root, np.int64)
    for i in np.flatnonzero(nodes["left"] >= 0):
        number[nodes["left"][i] : nodes["left"][i] + 2] = 2 * number[i], 2 * number[i] + 1
    order = np.argsort(number)
    return {"number": number[order], **{n: v[order] for n, v in nodes.items() if n != "left"}}


@pytest.mark.parametrize("classes", [4, 0])
def test_large_nodes_are_split_one_by_one_as_by_levels(monkeypatch, classes):
    *data, s = _rows(classes)
    found = []
    for limit in (10**6, 300):
        monkeypatch.setattr(forest, "LEVEL_ROWS", limit)
        found.append(_numbered(forest.grow(*data, 0, 2, s), 2))
    assert len(found[0]["number"]) == len(found[1]["number"]) > 100
    # Two features that part the same rows gain the same but for rounding.
    for name, v in found[0].items():
        assert np.isclose(v, found[1][name]).mean() > 0.99, name


def test_weights_of_classes_and_of_rows_give_the_same_sums():
    x, y, w, count, s = _rows(4)
    known = forest.Drawn(x, y, w, count, s)
    assert known.by_class is not None
    uneven = w.copy()
    uneven[0] += 1e-9
    others = forest.Drawn(x, y, uneven, count, s)
    assert others.by_class is None
    for a, b in zip(known.sums(known.x[1].astype(int), 200, slice(None)), others.sums(others.x[1].astype(int), 200, slice(None))):
        assert np.allclose(a, b)
    for v in (w, uneven, np.ones(len(w))):
        assert np.array_equal(forest._read_weights(forest._sent_weights(y, v, 4), y), v)
    assert len(forest._sent_weights(y, w, 4)) < 50


def test_rows_are_routed_through_many_nodes():
    x, *_ = _rows(4)
    top = {1: (0, 17), 2: (1, 100), 3: (1, 50), 5: (3, 40), 11: (2, 0)}
    expected = np.ones(len(x), int)
    for node, (feature, cut) in sorted(top.items()):
        here = expected == node
        expected[here] = 2 * node + (x[here, feature] > cut)
    assert np.array_equal(forest._routed(x, top), expected)
