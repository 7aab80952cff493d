"""Tokenizer alignment against sets of offsets, with ids of the tokenizers' own libraries."""

import hashlib
import json
import random
from bisect import bisect
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimloom.llm import alignment
from tests.llm.cases import SCHEMA, corpus, frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ROWS = [
    *corpus(12),
    *enumerate(
        ["<|endoftext|> a <s></s>", "▁x", "a\x00b\r\n\tc", "漢字かな交じり文 😀👩‍👩‍👧 é́", "  two  spaces  ", "x" * 4000, "<0x41> <unk>",
         "the the the theatre", "﻿bom", "ﬁ ½ Å", " "],
        start=3000,
    ),
    (None, "no id here"),
]


def libraries():
    """ids and bytes of both sides by the plain libraries."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    vocab = {i: t for t, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def both(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)
        ]
        return a, [bytes(byte[c] for c in vocab[i]) for i in a], b, b_bytes

    return both


def ends(pieces):
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def brute(rows):
    both, docs = libraries(), []
    for i, text in rows:
        a, a_bytes, b, b_bytes = both(text) if text else ([], [], [], [])
        if text and not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a = b = a_bytes = b_bytes = []
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        common = sorted(set(a_ends) & set(b_ends))
        at_a, at_b = dict(zip(a_ends, a)), dict(zip(b_ends, b))
        groups, i_a, i_b = [], 0, 0
        for end in common:
            to_a, to_b = bisect(a_ends, end), bisect(b_ends, end)
            groups.append("|".join(",".join(map(str, p)) for p in (a[i_a:to_a], b[i_b:to_b])))
            i_a, i_b = to_a, to_b
        docs.append((i, a, b, groups, [(at_a[e], at_b[e]) for e in common]))
    counts = Counter(link for d in docs for link in d[4])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    return sorted(
        (
            (i, len(a), len(b), len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links),
             sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for i, a, b, groups, links in docs
        ),
        key=repr,
    )


@pytest.mark.parametrize("head,lane,block", [(262_144, 256, 1_000_000), (20, 3, 500), (1, 1, 1), (0, 5, 50)])
def test_equals_sets_of_offsets(spark, monkeypatch, head, lane, block):
    """Also with few or no broadcast pairs, short lanes and small blocks."""
    monkeypatch.setattr(alignment, "HEAD_PAIRS", head)
    monkeypatch.setattr(alignment, "LANE", lane)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    monkeypatch.setattr(alignment, "SCORED_LINKS", block)
    got = alignment.scored(frame(spark, ROWS), A, B)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_lockstep_against_sets():
    draw = random.Random(3)
    for _ in range(200):
        a, b, first, base = [], [], [0], 0
        for _ in range(draw.randint(0, 5)):
            size = draw.choice([0, 1, 7, 60])
            if size:
                inner = range(base + 1, base + size)
                a += sorted(draw.sample(inner, draw.randint(0, size - 1))) + [base + size]
                b += sorted(draw.sample(inner, draw.randint(0, size - 1))) + [base + size]
            base += size
            first.append(len(a))
        kept, alignment.LANE = alignment.LANE, draw.choice([1, 2, 9, 256])
        cut_a, cut_b = alignment.lockstep(np.array(a, np.int64), np.array(b, np.int64), np.array(first))
        alignment.LANE = kept
        assert cut_a.tolist() == [x in set(b) for x in a] and cut_b.tolist() == [x in set(a) for x in b]


def test_alignments_spell_the_text(spark):
    both = libraries()
    texts = dict(r for r in ROWS if r[0] is not None and 3000 <= r[0] < 4000)
    for r in alignment.alignments(frame(spark, list(texts.items())), A, B).collect():
        a, a_bytes, b, b_bytes = both(texts[r.doc_id])
        if not r.a_ids:
            assert b"".join(b_bytes) != (" " + texts[r.doc_id]).encode() and not r.b_ids
            continue
        assert (r.a_ids, r.b_ids) == (a, b) and len(r.a_bounds) == len(r.b_bounds)
        for m, n in zip(r.a_bounds, r.b_bounds):
            assert b"".join(a_bytes[:m]) == b"".join(b_bytes[:n])
        assert (r.a_bounds[-1], r.b_bounds[-1]) == (len(a), len(b))


def test_very_long_text_and_empty_table(spark):
    rows = [(1, "some words, and 漢字 " * 60_000), (2, "y" * 300_000), (3, None)]
    got = alignment.scored(frame(spark, rows), A, B)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.scored(empty, A, B).collect() == [] and alignment.alignments(empty, A, B).collect() == []


def test_pair_counts(spark):
    links = spark.createDataFrame([([1, 2, 1], [5, 5, 5]), ([2, 7], [5, 6]), ([], [])], "link_a array<int>, link_b array<int>")
    got = {(r.a, r.b): (r.n, r.best) for r in alignment.pair_counts(links.withColumn("row", F.lit(0))).collect()}
    assert got == {(1, 5): (2, True), (2, 5): (2, True), (7, 6): (1, True)}
