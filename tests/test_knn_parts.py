"""Nearest neighbours over several parts of space."""

import numpy as np
import pytest

from claimloom.operators import knn
from tests.test_knn import brute, frame_of


@pytest.mark.parametrize("width, block", [(4, 4096), (20, 16)])
def test_parts_and_shares_give_exact_neighbours(spark, monkeypatch, width, block):
    for name, value in (("LEAST_ROWS", 30), ("RING_ROWS", 8), ("BLOCK_ROWS", block), ("PIECE_ROWS", 7)):
        monkeypatch.setattr(knn, name, value)
    draw = np.random.default_rng(8)
    base = np.vstack([draw.normal(0, 1, (150, width)), draw.integers(0, 2, (100, width)), np.zeros((40, width))])
    base = base[draw.permutation(len(base))]
    queries = np.vstack([base[::5], draw.normal(0, 3, (40, width)).astype(np.float32), np.full((3, width), 1e4)])
    near = knn.knn_join(frame_of(spark, queries), frame_of(spark, base), 6).collect()
    assert {(r.id, r.neighbour, r.distance, r["rank"]) for r in near} == brute(queries, base, 6)


def test_fine_values_within_categories_are_told_apart(spark):
    """Rows that differ in categories by much and in shares by little: few pairs are compared, and none is missed."""
    draw = np.random.default_rng(2)
    rows = lambda n: np.column_stack([draw.random((n, 2)) / 1000, draw.integers(0, 2, n), draw.integers(0, 24, n) / 8])
    base, queries = rows(6000), rows(300)
    report = {}
    near = knn.knn_join(frame_of(spark, queries), frame_of(spark, base), 5, report=report).collect()
    assert {(r.id, r.neighbour, r.distance, r["rank"]) for r in near} == brute(queries, base, 5)
    assert report["compared"] < 0.15 * report["all"]


def test_approximate_ways_agree_and_store_no_pairs(spark, monkeypatch):
    """Buckets compared one by one, in blocks, or all at once with their keys: the same rows. Pairs are not stored."""
    draw = np.random.default_rng(3)
    base = frame_of(spark, np.vstack([draw.normal(0, 1, (250, 8)), np.ones((30, 8))])).cache()
    stored, as_table = [], knn.as_table

    def watched(frame, name, *rest):
        table = as_table(frame, name, *rest)
        stored.append(table.count())
        return table

    monkeypatch.setattr(knn, "as_table", watched)
    found = []
    # Narrow buckets are compared one by one, wide ones all at once.
    for width, hot in ((2.0, 16_384), (2.0, 12), (60.0, 16_384)):
        monkeypatch.setattr(knn, "HOT_ROWS", hot)
        near = knn.approximate_knn_join(base, base, 4, exclude_self=True, hashes=1, tables=3, width=width)
        found.append({(r.id, r.neighbour, r.distance, r["rank"]) for r in near.collect()})
    assert found[0] == found[1] and len(found[0]) > 1000
    exact = knn.knn_join(base, base, 4, exclude_self=True)
    assert found[2] == {(r.id, r.neighbour, r.distance, r["rank"]) for r in exact.collect()}
    assert max(stored) <= 280 * 4
