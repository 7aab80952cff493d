"""Repeated substrings, repeated passages and benchmark leaks against brute force."""

import collections
import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from claimloom.llm import decontaminate, passages, suffixes
from tests.llm.cases import LOWER, SCHEMA, WORD, corpus, frame, sentence


def removed(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        rest = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,most", [(64, 4096), (100, 2), (400, 4096)])
def test_substrings_equal_brute_force(spark, length, most):
    rows = corpus(21) + [(700, "ab" * 600), (701, "x" * length), (702, "x" * length), (None, "y" * length * 2)]
    got = suffixes.without_repeats(frame(spark, rows), length, most=most).drop("spans")
    assert sorted(map(tuple, got.collect()), key=repr) == removed(rows, length)


def test_suffix_order():
    draw = random.Random(22)
    data = "".join(draw.choice("ab") for _ in range(900)) + "ab" * 200
    array = np.frombuffer(data.encode(), np.uint8)
    places = np.arange(len(data) - 80)
    order, _ = suffixes.Suffixes(array, 80).sort(places, np.zeros(len(places), np.uint64))
    assert [data[p : p + 80] for p in order] == sorted(data[p : p + 80] for p in places)
    x, y = np.array([0, 5, 900]), np.array([3, 700, 902])
    shared = [next((k for k in range(80) if data[a + k] != data[b + k]), 80) for a, b in zip(x, y)]
    assert suffixes.Suffixes(array, 80).common(x, y).tolist() == shared


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert suffixes.without_repeats(nothing).collect() == []
    assert passages.repeated_passages(nothing).collect() == []
    assert decontaminate.leaks(nothing, bench).collect() == []
    some = frame(spark, [(1, "a b c d e f g h")])
    assert decontaminate.leaks(some, bench).collect() == []
    assert decontaminate.without_leaks(some, bench).count() == 1


def test_passages(spark):
    """Every stretch of 49 equal words is found, near-equal lines are, and nothing else is."""
    draw = random.Random(23)
    inline = [sentence(draw, 52) for _ in range(3)]
    line = sentence(draw, 60).split()
    near = list(line)
    near[30] = "CHANGED"
    rows = [(i, sentence(draw, 200)) for i in range(20)]
    rows += [(100 + i, f"{sentence(draw, 20 + i)} {inline[i % 3]} {sentence(draw, 9)}") for i in range(9)]
    rows += [(200, " ".join(line) + "\n" + sentence(draw, 30)), (201, sentence(draw, 30) + "\n" + " ".join(near))]
    rows += [(300, None), (301, ""), (302, "same few words"), (303, "same few words"), (304, inline[0] + "\n" + inline[0])]
    got = {r.doc_id: r for r in passages.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == set(range(100, 109)) | {200, 201, 304}
    texts = dict(rows)
    occurrences = collections.defaultdict(list)
    for i, r in got.items():
        assert r.n_passages == len(r.passages) and r.n_removed == sum(not p.kept for p in r.passages)
        for p in r.passages:
            occurrences[p.component].append((i, p.start, p.kept))
            assert len(WORD.findall(texts[i].encode()[p.start : p.end].decode())) >= passages.WINDOW
    for places in occurrences.values():
        assert len(places) > 1 and [kept for _, _, kept in sorted(places)] == [True] + [False] * (len(places) - 1)
    assert got[100].n_removed == 0 and got[103].n_removed > 0


def tokens(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def tiling(left, right, least):
    """Greedy string tiling as published: scan for the longest free matches, mark them, repeat."""
    used_l, used_r = [False] * len(left), [False] * len(right)
    covered = 0
    while True:
        best = least - 1
        found = []
        for q in range(len(right)):
            for p in range(len(left)):
                n = 0
                while (p + n < len(left) and q + n < len(right) and left[p + n] == right[q + n]
                       and not used_l[p + n] and not used_r[q + n]):
                    n += 1
                if n > best:
                    best, found = n, [(q, p)]
                elif n == best and n >= least:
                    found.append((q, p))
        if best < least:
            return covered
        for q, p in found:
            if not any(used_l[p : p + best]) and not any(used_r[q : q + best]):
                used_l[p : p + best] = used_r[q : q + best] = [True] * best
                covered += best


def test_leaks_equal_tiling(spark):
    draw = random.Random(24)
    items = [(i, sentence(draw, draw.randint(12, 40))) for i in range(12)] + [(50, None), (51, "too short"), (52, ""), (3, "x y z a b c")]
    rows = [(i, sentence(draw, draw.randint(5, 80))) for i in range(30)]
    for i, text in items[:12]:
        words = text.split()
        half = len(words) // 2
        rows.append((100 + i, f"{sentence(draw, 10)} {text} {sentence(draw, 5)}"))
        rows.append((200 + i, f"{' '.join(words[half:]).upper()}! -- {sentence(draw, 4)} {' '.join(words[:half])}"))
        rows.append((300 + i, " ".join(words[: half + 2])))
        rows.append((400 + i, " ".join(w for k, w in enumerate(words) if k % 4)))
    rows += [(500, None), (501, ""), (502, "word " * 300), (503, "X, y; z a\nb c")]
    bench = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    for most in (decontaminate.BLOCK_CHARS, 300):
        got = decontaminate.leaks(frame(spark, rows), bench, threshold=0.8, most=most).collect()
        wanted = set()
        for d, text in rows:
            for i, item in items:
                right = tokens(item)
                covered = tiling(tokens(text), right, decontaminate.LEAST) if len(right) >= decontaminate.LEAST else 0
                if right and covered >= 0.8 * len(right) and covered:
                    wanted.add((d, i, covered, len(right)))
        assert {(r.doc_id, r.item_id, r.n_matched, r.n_tokens) for r in got} == wanted
    assert {100 + i for i in range(12)} | {200 + i for i in range(12)} <= {r.doc_id for r in got}
    kept = decontaminate.without_leaks(frame(spark, rows), bench, threshold=0.8)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {w[0] for w in wanted}


def test_leaks_at_the_threshold_of_the_queries(spark):
    """Edited and cut passages against the tiling, with the default coverage."""
    draw = random.Random(25)
    items = [(i, sentence(draw, 30)) for i in range(10)]
    rows = [(i, sentence(draw, 40)) for i in range(10)]
    for i, text in items:
        words = text.split()
        rows.append((100 + i, f"{sentence(draw, 6)} {' '.join(words[:20])}"))
        rows.append((200 + i, " ".join([*words[:10], "edited", *words[11:20], "again", *words[21:]])))
        rows.append((300 + i, " ".join(words[:15])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    covered = {(d, i): tiling(tokens(t), tokens(item), decontaminate.LEAST) for d, t in rows for i, item in items}
    wanted = {k for k, n in covered.items() if n >= 0.6 * len(tokens(items[k[1]][1]))}
    assert {(100 + i, i) for i in range(10)} | {(200 + i, i) for i in range(10)} <= wanted
    assert {(d, i) for d, i in wanted if covered[d, i] < 0.8 * len(tokens(items[i][1]))}
    got = decontaminate.leaks(frame(spark, rows), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == wanted
    kept = decontaminate.without_leaks(frame(spark, rows), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in wanted}


def test_runs_are_all_maximal_common_runs(monkeypatch):
    """Few different tokens, so that equal runs of five are many; also when texts are taken in several parts."""
    draw = random.Random(29)
    for _ in range(150):
        letters = "abcdef"[: draw.randint(1, 6)]
        texts, items = ([" ".join(draw.choice(letters) for _ in range(draw.randint(0, 50))) for _ in range(4)] for _ in range(2))
        monkeypatch.setattr(decontaminate, "MOST_RUNS", draw.choice([1, 40, 2_000_000]))
        index, words = decontaminate.Items(list(enumerate(items))), decontaminate.tokens(texts)
        got = collections.Counter()
        for at, place, length in index.runs(words):
            for p, q, n in zip(at.tolist(), place.tolist(), length.tolist()):
                t, i = int(words.texts()[p]), int(index.owner[q])
                got[t, i, p - int(words.first[t]), q - int(index.first[i]), n] += 1
        wanted = collections.Counter()
        for t, left in enumerate(map(str.split, texts)):
            for i, right in enumerate(map(str.split, items)):
                for p in range(len(left)):
                    for q in range(len(right)):
                        n = 0
                        while p + n < len(left) and q + n < len(right) and left[p + n] == right[q + n]:
                            n += 1
                        if n >= decontaminate.LEAST and not (p and q and left[p - 1] == right[q - 1]):
                            wanted[t, i, p, q, n] += 1
        assert got == wanted


def test_a_million_equal_words():
    items = decontaminate.Items([(1, "word " * 300), (2, "word " * 7 + "other"), (3, "clean words that no text of this test holds")])
    tracemalloc.start()
    found = decontaminate.leaks_of(["word " * 1_000_000, "a b c"], items, 0.6)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r[:4] for r in sorted(found)] == [(0, 0, 300, 300), (0, 1, 7, 8)]
    assert most < 500_000_000
