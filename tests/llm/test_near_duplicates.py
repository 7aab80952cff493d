"""Near-duplicate documents against all pairs."""

import pytest

from claimloom.llm import minhash
from claimloom.llm.components import components
from tests.llm.cases import LOWER, SCHEMA, WORD, corpus, frame


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted((i, len(s), find(i) if s else i, i == (find(i) if s else i)) for i, s in sets)


@pytest.mark.parametrize("words,percent,block", [(4, 80, 512), (2, 60, 2)])
def test_equals_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(1)
    got = minhash.near_duplicates(frame(spark, rows), words, percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, words, percent)


def test_chain_through_a_bucket(spark):
    """Each text is linked to the next only; all are one component."""
    words = [f"w{i}" for i in range(300)]
    rows = [(10 - k, " ".join(words[10 * k : 10 * k + 120])) for k in range(8)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), 4, 80).collect()}
    assert got == {i: 3 for i, _ in rows}


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 3), (None, 4)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}
