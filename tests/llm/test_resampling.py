"""Importance resampling against a plain version on sets of strings."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm import resampling
from tests.llm.cases import LOWER, SCHEMA, corpus, frame, sentence

TARGET = "item_id long, text string, key string"


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(rows, target, buckets, least=20, numerator=25, denominator=100):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    ]
    out, eligible = [], []
    for at, (i, text) in enumerate(rows):
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words) >= least:
                eligible.append((-score, i, len(found), at))
        out.append([i, len(words), len(found), weight, score, None])
    for place, (*_, at) in enumerate(sorted(eligible)[: len(eligible) * numerator // denominator], 1):
        out[at][5] = place
    return sorted(map(tuple, out), key=repr)


ROWS = [*corpus(11), (None, "a text without an id " * 9), (302, "Ünïcode ǅ 漢字 " * 30), (9, "0 1 x" * 40)]
ITEMS = [sentence(random.Random(3), 40), None, "", "stone river stone river and the light"]


def run(spark, rows, items, **settings):
    target = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], TARGET)
    return sorted(map(tuple, resampling.resampled(frame(spark, rows), target, **settings).collect()), key=repr)


@pytest.mark.parametrize("buckets", [10_000, 50])
def test_equals_plain_version(spark, buckets):
    assert run(spark, ROWS, ITEMS, buckets=buckets) == brute(ROWS, ITEMS, buckets)


@pytest.mark.parametrize("words,pairs,counted", [(0, 0, 400_000), (3, 2, 20), (10_000, 0, 50)])
def test_head_decides_nothing(spark, monkeypatch, words, pairs, counted):
    """Few or no frequent features, and texts cut into short slices."""
    monkeypatch.setattr(resampling, "HEAD_WORDS", words)
    monkeypatch.setattr(resampling, "HEAD_PAIRS", pairs)
    monkeypatch.setattr(resampling, "COUNTED", counted)
    monkeypatch.setattr(resampling, "SLICE_BYTES", 50)
    assert run(spark, ROWS, ITEMS) == brute(ROWS, ITEMS, 10_000)


def run_of(texts, monkeypatch, most=1_000_000):
    monkeypatch.setattr(resampling, "SLICE_BYTES", most)
    return list(resampling.runs(pa.array(texts, pa.string())))


def test_head_and_tail_give_one_bucket(monkeypatch):
    draw = random.Random(4)
    words = [draw.choice(["a", "bc", "é", "7", "zz"]) for _ in range(400)]
    coded = [w.encode() for w in words]
    counts, pairs = Counter(coded), Counter(zip(coded, coded[1:]))
    singles = [zlib.crc32(w) % 77 for w in coded]
    couples = [zlib.crc32(a + b" " + b) % 77 for a, b in zip(coded, coded[1:])]
    (run,) = run_of([" ".join(words)], monkeypatch)
    for n in range(6):
        head = resampling.Head.of([w for w, _ in counts.most_common(n)], [p for p, _ in pairs.most_common(3 * n)], 77)
        found = head.features(run, 77)
        assert (found[0].tolist(), found[1].tolist(), found[2].tolist()) == (singles, couples, list(range(399)))


@pytest.mark.parametrize("most", [1, 3, 10, 100, 1_000_000])
def test_runs_cut_no_word(monkeypatch, most):
    texts = ["ab cd" * 50 + "long" * 40 + " end", None, "", "  Two words  ", "-" * 90 + "x" + "-" * 90, "one"]
    found = {i: ([], []) for i in range(len(texts))}
    for run in run_of(texts, monkeypatch, most):
        for t in range(len(run.first) - 1):
            words = [run.texts()[i].decode() for i in run.at[run.first[t] : run.first[t + 1]]]
            found[run.row + t][0].extend(words[run.led :])
        place = run.pairs()
        owner = np.searchsorted(run.first, place, side="right") - 1
        for p, t in zip(place.tolist(), owner.tolist()):
            found[run.row + t][1].append(" ".join(run.texts()[i].decode() for i in run.at[p : p + 2]))
    for i, text in enumerate(texts):
        words, both = features(text)
        assert found[i] == (words, both[len(words) :])


def test_frequent_counts_have_bounded_error(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COUNTED", 40)
    draw = random.Random(8)
    texts = [" ".join(f"w{int(draw.expovariate(0.05))}" for _ in range(300)) for _ in range(20)]
    found = resampling._texts(frame(spark, list(enumerate(texts)), 1), "text").mapInArrow(
        resampling.count_features, "first binary, second binary, n long"
    )
    got = {bytes(r["first"]): r["n"] for r in found.filter("second IS NULL").collect()}
    want = Counter(w.encode() for t in texts for w in t.split())
    read = 2 * sum(want.values())
    for word, n in want.items():
        assert n - read * 2 / 40 - 1 <= got.get(word, 0) <= n


def test_no_target_long_text_and_empty_table(spark):
    rows = [(1, "word and other " * 200_000), (2, "x" * 3_000_000), *[(i, sentence(random.Random(i), 30)) for i in range(3, 30)]]
    assert run(spark, rows, []) == brute(rows, [], 10_000)
    assert run(spark, [], ITEMS) == []


def test_sample_keeps_columns(spark):
    docs = frame(spark, ROWS)
    target = spark.createDataFrame([(1, ITEMS[0], "x")], TARGET)
    drawn = {r.doc_id for r in resampling.resampled(docs, target).filter("rank IS NOT NULL").collect()}
    got = resampling.sample(docs.withColumn("score", F.lit(1)), target)
    assert got.columns == [*docs.columns, "score"] and {r.doc_id for r in got.collect()} == drawn and drawn
    assert resampling.sample(spark.createDataFrame([], SCHEMA), target).collect() == []
