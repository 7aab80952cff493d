"""Quality, secrets, language and lines against plain Python."""

import collections
import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline
from claimloom.llm import language, lines, quality, secrets
from claimloom.llm.automata import Automaton
from tests.llm.cases import LOWER, SCHEMA, WORD, corpus, frame, sentence


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, dup, len(cover))


def test_quality_statistics(spark):
    rows = corpus(2) + [(600, "a b\n\na b\n a b\na b"), (601, "x #$|\nx #$|\n"), (602, "é ü ß"), (None, "a b")]
    got = quality.judged(frame(spark, rows)).collect()
    wanted = collections.Counter((i, *statistics(t)) for i, t in rows)
    assert collections.Counter((r.doc_id, *[r[c] for c in quality.STATISTICS[:5]]) for r in got) == wanted
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed) and 0 <= r.quality <= 1


def test_estimate_finds_accuracies():
    """Votes drawn from known accuracies: the estimate is near them and the posterior separates."""
    draw = np.random.default_rng(5)
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.6, 0.9])
    good = draw.random(20000) < 0.7
    correct = draw.random((20000, 6)) < right
    votes = np.where(correct == good[:, None], 1, -1)
    votes[draw.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    trust = quality.estimate(patterns, counts.astype(float))
    assert abs(trust.prior - 0.7) < 0.03
    assert np.abs(np.array(trust.on_good) - right).max() < 0.04
    assert np.abs(np.array(trust.on_bad) - right).max() < 0.06


def test_quality_keeps_prose_and_drops_noise(spark):
    draw = random.Random(4)
    prose = [(i, "\n".join(sentence(draw, 40) + "." for _ in range(3))) for i in range(80)]
    noise = [(200 + i, " ".join(w + "***" for w in sentence(draw, 80).split())) for i in range(20)]
    kept = {r.doc_id for r in quality.judged(frame(spark, prose + noise)).filter("kept").collect()}
    assert kept == set(range(80))


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    for found in (quality.judged(nothing), secrets.scan(nothing), language.predict(nothing), lines.without_repeats(nothing)):
        assert found.collect() == []


def test_automaton_equals_re():
    draw = random.Random(8)
    patterns = ["ab", "a(b|c)*d", "[ab]{3,}c?", r"(?i:key)\x20*=", "x+y", "(a|ab)(c|bcd)", "c[a-c]"]
    single = [(p, Automaton([p])) for p in patterns]
    search = Automaton(patterns, search=True)
    for _ in range(3000):
        text = "".join(draw.choice("abcdxyKkeE =") for _ in range(draw.randint(0, 9)))
        for p, a in single:
            state = 0
            for b in text.encode():
                state = a.next[state, a.column[b]] if state >= 0 else -1
            assert (state >= 0 and bool(a.accepts[state])) == bool(re.fullmatch(p, text)), (p, text)
        state = 0
        for b in text.encode():
            state = search.next[state, search.column[b]]
        assert bool(search.accepts[state]) == any(re.search(p, text) for p in patterns)


def test_backwards_automaton_marks_where_matches_begin():
    draw = random.Random(10)
    patterns = ["ab", "a(b|c)*d", "[ab]{3,}c?", r"(?i:key)\x20*=", "x+y", "(a|ab)(c|bcd)"]
    back = Automaton(patterns, backwards=True)
    for _ in range(1000):
        text = "".join(draw.choice("abcdxyKkeE =") for _ in range(draw.randint(1, 12)))
        state = 0
        for i in range(len(text) - 1, -1, -1):
            state = back.next[state, back.column[ord(text[i])]]
            begins = [bool(re.compile(p).match(text, i)) for p in patterns]
            assert [bool(back.accepts[state] >> k & 1) for k in range(len(patterns))] == begins, (text, i)


@pytest.mark.parametrize("part", ["eyJ", "eyJ.", "eyJa.", "password ", "-----BEGIN RSA "])
def test_a_megabyte_of_beginnings_takes_linear_time(part):
    text = (part * (1_000_000 // len(part)) + " token=" + "x" * 12).encode()
    offsets = np.array([0, len(text)])
    begun = time.process_time()
    found = secrets.secrets_of(np.frombuffer(text, np.uint8), offsets, secrets.RULES)
    assert time.process_time() - begun < 20
    assert (len(text) - 18, len(text), 0) in found[0]


def either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
BASE = (
    ("assign", re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
)


def base_spans(text):
    found = [
        (m.start(), k, m.end())
        for k, (_, pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


@pytest.mark.parametrize("long", [secrets.LONG, 40])
def test_secrets_equal_re(spark, monkeypatch, long):
    monkeypatch.setattr(secrets, "LONG", long)
    draw = random.Random(9)
    parts = ["password", "PassWd", "api_key", "apikey", "Token", "secret", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCDEFGH",
             "0123456789ab", "cdef0123", "xyz-._/+", "é", "ß,", "\n", "==", "ghp_", "ſecret", "AKIA0"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "deadbeef" * 5000), (1003, "Ab9" * 3000 + " token = " + "Zz" * 50)]
    got = {r.doc_id: r for r in secrets.scan(frame(spark, rows)).collect()}
    for i, text in rows:
        wanted = base_spans(text)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest(), (text, wanted, r.spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k[0] + ":") for s in wanted) for k in BASE)
        assert set(wanted) <= set(r.spans.split(",")) | {""}


def test_more_kinds_of_secrets(spark):
    text = "é ghp_" + "a1B2" * 9 + "\n-----BEGIN RSA PRIVATE KEY-----\nxoxb-1234567890-x"
    spans = secrets.scan(frame(spark, [(1, text)])).first().spans.split(",")
    assert [s.split(":")[0] for s in spans] == ["code_host", "key_block", "chat"]
    a, b = map(int, spans[0].split(":")[1:])
    assert text[a:b] == "ghp_" + "a1B2" * 9


def phrases(text, sample):
    """Greedy longest phrases of ``text`` that occur in ``sample``."""
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        count += 1
        at += n
    return count


def test_phrase_counts():
    draw = random.Random(11)
    samples = {k: sentence(random.Random(k), 150, w.split()) for k, w in {1: "ba bo bi da do", 2: "ka ko ki ta ba"}.items()}
    texts = [sentence(draw, 30, "ba ka do ki zu".split()) for _ in range(20)] + [""]
    counts, letters = language.phrase_counts(texts, tuple(samples.values()))
    for text, found, n in zip(texts, counts, letters):
        assert n == sum(c.isalpha() for c in text)
        assert found.tolist() == [phrases(text, s) for s in samples.values()]


def test_tables_grow_with_the_samples_and_not_with_the_alphabet():
    """A sample of 3,000 different Chinese characters beside two Latin ones; phrases against a plain greedy parse."""
    draw = random.Random(14)
    signs = [chr(0x4E00 + k) for k in range(3000)]
    odds = [1 / (k + 1) for k in range(3000)]
    chinese = "".join(signs) + "".join(draw.choices(signs, odds, k=27_000))
    samples = (chinese, sentence(draw, 6000)[:30_000], "die katze und der hund " * 1300)
    tables = language.Tables(samples)
    assert sum(a.nbytes for a in (tables.cells, tables.row_of, tables.symbol, tables.target, tables.columns)) < 300_000_000
    texts = [chinese[5000:5400] + signs[7] * 3, sentence(draw, 30), "hund \u9fa0 und Katze", "", "\u0416\u0416 der"]
    counts, _ = language.phrase_counts(texts, samples)
    for k, sample in enumerate(samples):
        known = "".join(c if c.isalpha() else " " for c in sample.lower())
        for t, text in enumerate(texts):
            left = "".join(c if c.isalpha() else " " for c in text.lower()).rstrip() if text else ""
            phrases = 0
            while left:
                n = 1
                while n < len(left) and left[: n + 1] in known:
                    n += 1
                phrases, left = phrases + 1, left[n:]
            assert abs(int(counts[t, k]) - phrases) <= 1, (k, t)


def test_language_held_out_accuracy(spark):
    draw = random.Random(12)
    vocab = {"aa": "bola dira muneta foro sali", "bb": "krist vlok brun drang schtel", "cc": "xiqu yuwa zhenli oqa"}
    rows = []
    for i in range(600):
        lang = draw.choice(list(vocab))
        rows.append((i, sentence(draw, draw.randint(6, 40), vocab[lang].split()), lang))
    rows += [(1000, None, "aa"), (1001, "12 .. 3", "bb"), (1002, "", None), (1003, "x" * 5000, None), (None, "bola dira", None)]
    got = language.predict(frame(spark, rows)).collect()
    by = {i: lang for i, _, lang in rows}
    checked = [r for r in got if r.held_out and r.doc_id < 600]
    assert len(checked) > 80 and all(r.lang_pred == by[r.doc_id] for r in checked)
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    docs = frame(spark, rows)
    kept = language.accepted(docs, language.training_samples(docs))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(600)) and not {r.doc_id for r in kept.collect()} & {1000, 1001, 1002}


def test_rare_label_leaves_the_others_their_samples(spark):
    """A label of one short row, or of one ordinary row, beside large ones."""
    draw = random.Random(15)
    vocab = {"bb": "bola dira muneta foro sali pemo", "cc": "krist vlok brun drang schtel", "dd": "xiqu yuwa zhenli oqa dira"}
    rows = [(i, sentence(draw, 40, vocab[lang].split()), lang) for i, lang in enumerate(sorted(vocab) * 150)]
    free = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5]
    other = "pomezu weckat linto graf".split()
    for rare in ("Hi", sentence(draw, 30, other)):
        docs = frame(spark, rows + [(free[0], rare, "aa"), (free[1], rare, "xx"), (2000, sentence(draw, 40, other), None)])
        samples = language.training_samples(docs)
        assert samples["aa"] == samples["xx"] == rare and min(len(samples[k]) for k in vocab) > 10_000
        got = {r.doc_id: r for r in language.predict(docs).collect()}
        assert all(got[i].lang_pred == lang and got[i].score > 0 for i, _, lang in rows)
        assert rare == "Hi" or got[2000].lang_pred == "aa"
        assert {r.doc_id for r in language.accepted(docs, samples).collect()} >= set(range(len(rows)))
    assert language.even_share([2, 5, 9, 9], 20) == 6 and language.even_share([2, 5], 20) == 5 and language.even_share([], 3) == 0


def test_all_sampled_rows_count(spark):
    """Every slot's text is in the sample, short ones whole, and the sample is filled."""
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} " + "lorem ipsum " * (60 if i % 2 else 1), "aa") for i in range(200)]
    sample = language.samples_of(frame(spark, rows), "lang", "text", "doc_id", letters=6000, rows=2000)["aa"]
    assert 5700 < len(sample) <= 6000
    found = set(sample.split())
    assert sum(t.split()[0] in found for _, t, _ in rows) > 180


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables are not here")
def test_rare_label_in_the_first_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    free = next(i for i in range(10**9, 10**9 + 99) if zlib.crc32(str(i).encode()) % 5)
    values = {"doc_id": free, "text": "Hi", "lang": "xx", "n_chars": 2}
    extra = spark.createDataFrame([tuple(values.get(c) for c in docs.columns)], docs.schema)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    wanted = {r.doc_id for r in stage(spark, docs, "").collect()}
    assert wanted <= {r.doc_id for r in stage(spark, docs.unionByName(extra), "").collect()}


def without_repeats(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holds = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holds[key(line)].add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if i is None or len(holds[key(x)]) < 3 or i == max(holds[key(x)])]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines(spark):
    draw = random.Random(13)
    shared = [sentence(draw, 6) for _ in range(12)] + ["ÉCLAIR Über Straße AND MORE", "short line"]
    rows = []
    for i in range(80):
        own = [draw.choice(shared) if draw.random() < 0.5 else sentence(draw, 5) for _ in range(draw.randint(0, 9))]
        rows.append((i, "\n".join(draw.choice(["", " ", "\t"]) + (x.upper() if draw.random() < 0.2 else x) for x in own)))
    rows += corpus(14) + [(900, "\n".join(shared * 20)), (901, "\n\n\n"), (None, shared[0]), (3, shared[1])]
    got = lines.without_repeats(frame(spark, rows))
    found = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text) for r in got.collect()), key=repr)
    assert found == without_repeats(rows)
    assert set(cols := frame(spark, rows[:1]).columns) <= set(got.columns) and len(got.columns) == len(cols) + 2
