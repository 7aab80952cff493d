"""Exact duplicates against a dictionary of texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from claimloom.llm import owners
from tests.llm.cases import SCHEMA, corpus, frame

ROWS = [*corpus(13), *[(1000 + i, "same for a third of all rows") for i in range(60)], (None, "one"), (None, "alone")]


def brute(rows, largest):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def result(found):
    return sorted((tuple(r) for r in found.select("doc_id", *owners.ADDED).collect()), key=repr)


@pytest.mark.parametrize("largest", [True, False])
def test_equals_dictionary(spark, largest):
    assert result(owners.owners(frame(spark, ROWS), largest)) == brute(ROWS, largest)


@pytest.mark.parametrize("digest", [lambda t: F.lit("0"), lambda t: F.substring(F.md5(t), 1, 1)])
def test_texts_that_clash_in_length_and_hash(spark, monkeypatch, digest):
    """With poor hashes and little memory only the bytes tell texts apart."""
    monkeypatch.setattr(owners, "TRIE_BYTES", 300)
    rows = [*ROWS, *[(2000 + i, f"{i % 7:03}" + "x" * 200) for i in range(30)]]
    assert result(owners.owners(frame(spark, rows), True, digest=digest)) == brute(rows, True)


def test_hot_texts_are_merged_in_parts(spark, monkeypatch):
    monkeypatch.setattr(owners, "HOT_SHARE", 100_000)
    rows = [(i, "hot" if i % 3 else f"text {i // 6}") for i in range(300)]
    assert result(owners.owners(frame(spark, rows, parts=12), True)) == brute(rows, True)


def test_trie_against_dictionary():
    draw = random.Random(5)
    words = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    trie, want = owners.Trie(), {}
    got = {}
    for i, w in enumerate(words):
        trie.insert(w, -i, 1)
        least, n = want.get(w, (0, 0))
        want[w] = (min(least, -i), n + 1)
        if i == 1500:
            for key, owner, copies in trie.drain_largest():
                got[key] = (owner, copies)
    for key, owner, copies in trie.drain():
        before = got.get(key, (0, 0))
        got[key] = (min(before[0], owner), before[1] + copies)
    assert got == want and trie.bytes == 0


def test_common_prefix():
    draw = random.Random(6)
    for _ in range(500):
        a, b = (bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(2))
        n = owners.common_prefix(a, b)
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_very_long_texts_and_empty_table(spark):
    long = "word " * 600_000
    rows = [(1, long), (2, long), (3, long + "."), (4, None), (5, "")]
    assert result(owners.owners(frame(spark, rows), True)) == brute(rows, True)
    empty = spark.createDataFrame([], SCHEMA)
    assert owners.owners(empty).collect() == []
    assert sorted(r.doc_id for r in owners.without_copies(frame(spark, rows)).collect()) == [1, 3, 4]


def test_clashing_columns_pass_through(spark):
    given = frame(spark, ROWS).withColumn("owner", F.lit("o")).withColumn("length", F.lit(3)).withColumn("copies", F.lit(1))
    assert owners.owners(given).columns == [*given.columns, *owners.ADDED]
