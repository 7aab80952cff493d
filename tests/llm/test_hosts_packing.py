"""Host scores and packing against brute force; the pipeline's stages and the registered queries."""

import collections
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from claimloom.llm import hosts, packing, queries
from tests.llm.cases import SCHEMA, corpus, frame

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, links string"


needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def scores(pages, rules):
    """Plain power iteration over the graph of hosts."""
    read = [(*split_url(u), h or "") for _, u, h in pages]
    names = sorted({h for h, _, _ in read if h})
    at = {h: k for k, h in enumerate(names)}
    links = np.zeros((len(names), len(names)))
    for host, _, html in read:
        for to in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html):
            if host and to.lower() in at and to.lower() != host:
                links[at[host], at[to.lower()]] += 1
    for host in names:
        up = host.split(".", 1)[1] if "." in host else ""
        if up in at:
            links[at[host], at[up]] += 1
            links[at[up], at[host]] += 1
    out = []
    for verdict, graph in (("allow", links), ("block", links.T)):
        seeds = np.zeros(len(names))
        for host, path, _ in read:
            rule = rule_of(host, path, rules)
            if rule and rule[2] == verdict:
                seeds[at[host]] += 1
        seeds = seeds / max(seeds.sum(), 1)
        sums = graph.sum(axis=1, keepdims=True)
        share = np.divide(graph, sums, out=np.zeros_like(graph), where=sums > 0)
        state = seeds
        for _ in range(hosts.ROUNDS):
            state = (1 - hosts.DAMPING) * seeds + hosts.DAMPING * state @ share
        out.append(dict(zip(names, state)))
    return out


def test_hosts(spark):
    draw = random.Random(31)
    names = [f"{a}{b}" for b in ("one.org", "two.com", "three.net", "sub.three.net", "Four.example.org") for a in ("", "m.", "www.")]
    pages = []
    for i in range(200):
        host = draw.choice(names)
        to = "".join(f'<a HREF="http://{draw.choice(names)}/x">' for _ in range(draw.randint(0, 3)))
        pages.append((i, f"http://{host}/{draw.choice(['fr', 'de', 'en', 'es'])}/{i}{draw.choice(['', '?a=1', '#b'])}", to))
    pages += [(900, None, None), (901, "no host", ""), (902, "x://", "<a href='//three.net'>"), (903, "HTTP://M.ONE.ORG?q", None),
              (904, "a://b://c/d", None), (905, "", "x"), (5, "http://lonely.zz/", None), (None, "http://m.two.com/de/", None)]
    frame_ = spark.createDataFrame([(*p, "h", "l") for p in pages], PAGES).repartition(3)
    got = hosts.judge(frame_, queries.URL_RULES).collect()
    trust, distrust = scores(pages, queries.URL_RULES)
    wanted = collections.Counter()
    for i, url, _ in pages:
        host, path = split_url(url)
        rule = rule_of(host, path, queries.URL_RULES)
        verdict = rule[2] if rule else ("block" if distrust.get(host, 0) > trust.get(host, 0) + 1e-12 else "allow")
        wanted[(i, host, path, rule and rule[0] + rule[1], verdict)] += 1
    assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == wanted
    for r in got:
        assert r.trust == pytest.approx(trust.get(r.host, 0)) and r.distrust == pytest.approx(distrust.get(r.host, 0))
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    assert hosts.judge(spark.createDataFrame([], PAGES), queries.URL_RULES).collect() == []
    # Extra columns with the names that the operator uses itself.
    clashing = frame_
    for name in ("src", "dst", "kind", "hit", "trust", "distrust", "rule", "verdict", "path", "slot", "share"):
        clashing = clashing.withColumn(name, hosts.F.lit("x"))
    again = hosts.judge(clashing, queries.URL_RULES).collect()
    assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in again) == wanted


def settled_scores(pages, rules):
    """Power iteration to the end over hosts with and without pages and the domains above them."""
    read = [(*split_url(u), h or "") for _, u, h in pages]
    links = collections.Counter()
    names = {h for h, _, _ in read if h}
    for host, _, html in read:
        for to in re.findall(r"""href="http://([^/"]+)""", html):
            if to.lower() != host:
                links[host, to.lower()] += 1
                names.add(to.lower())
    for host in list(names):
        while host.count(".") > 1:
            up = host.split(".", 1)[1]
            links[host, up], links[up, host] = links[host, up] or 1, links[up, host] or 1
            names.add(up)
            host = up
    names = sorted(names)
    at = {h: k for k, h in enumerate(names)}
    graph = np.zeros((len(names), len(names)))
    for (a, b), n in links.items():
        graph[at[a], at[b]] = n
    out = []
    for verdict, g in (("allow", graph), ("block", graph.T)):
        seeds = np.zeros(len(names))
        for host, path, _ in read:
            rule = rule_of(host, path, rules)
            if rule and rule[2] == verdict:
                seeds[at[host]] += 1
        seeds = seeds / max(seeds.sum(), 1)
        sums = g.sum(axis=1, keepdims=True)
        share = np.divide(g, sums, out=np.zeros_like(g), where=sums > 0)
        out.append(dict(zip(names, np.linalg.solve(np.eye(len(names)) - hosts.DAMPING * share.T, (1 - hosts.DAMPING) * seeds))))
    return out


@pytest.mark.parametrize("slot_links", [hosts.SLOT_LINKS, 2])
def test_hosts_without_pages_pass_scores_on(spark, monkeypatch, slot_links):
    """Siblings share only a domain without pages; a link leads to a host without pages; hosts may be dealt to several slots."""
    plain = hosts.spread
    monkeypatch.setattr(hosts, "spread", lambda *args, **named: plain(*args, **named, slot_links=slot_links))
    rules = (("bad.zone.net", "/", "block"), ("good.site.com", "/", "allow"), ("far.deep.zone.net", "/", "allow"))
    hosts_ = ["bad.zone.net", "adult-x.zone.net", "a.b.zone.net", "good.site.com", "www.site.com", "far.deep.zone.net",
              "lonely.zz", "10.0.0.1", "11.0.0.1", "linker.one.org", "one.org"]
    pages = [(i, f"http://{hosts_[i % len(hosts_)]}/{i}", "") for i in range(44)]
    pages += [(100, "http://linker.one.org/", '<a href="http://cdn.bad.zone.net/x"> <a href="http://nowhere.yy/">')]
    frame_ = spark.createDataFrame([(*p, "h", "l") for p in pages], PAGES).repartition(3)
    got = hosts.judge(frame_, rules, whole=True, settled=hosts.SETTLED).collect()
    trust, distrust = settled_scores(pages, rules)
    assert len(got) == len(pages)
    for r in got:
        assert r.trust == pytest.approx(trust[r.host], abs=2e-6) and r.distrust == pytest.approx(distrust[r.host], abs=2e-6)
    by = {r.host: r for r in got}
    assert by["adult-x.zone.net"].verdict == "block" and by["adult-x.zone.net"].rule is None and by["adult-x.zone.net"].distrust > 0
    assert by["www.site.com"].trust > 0 and by["linker.one.org"].verdict == "block"
    assert by["10.0.0.1"].trust == by["lonely.zz"].distrust == 0


def test_plans_of_rounds_stay_small(spark, monkeypatch):
    """A stored plan holds two rounds at most, however many there are, and only the last state stays on disk."""
    joins, paths = [], []
    plain = hosts.next_table

    def watched(frame, *args):
        joins.append(frame._jdf.queryExecution().optimizedPlan().toString().count("Join Inner"))
        table, path = plain(frame, *args)
        paths.append(path)
        return table, path

    monkeypatch.setattr(hosts, "next_table", watched)
    seeds = spark.createDataFrame([("trust", "a", 1.0)], "kind string, host string, weight double")
    links = spark.createDataFrame([("trust", "a", "b", 1), ("trust", "b", "a", 1)], "kind string, src string, dst string, links long")
    got = {r.host: r.score for r in hosts.spread(seeds, links, rounds=11).collect()}
    state = [1.0, 0.0]
    for _ in range(11):
        state = [1 - hosts.DAMPING + hosts.DAMPING * state[1], hosts.DAMPING * state[0]]
    assert got == pytest.approx(dict(zip("ab", state)))
    assert sum(joins) == 11 and max(joins) <= 2
    assert [os.path.exists(p.removeprefix("file:")) for p in paths] == [False] * (len(paths) - 1) + [True]


@needs_tables
def test_host_query_spreads_on_the_given_tables(spark):
    """Pages without a rule get scores from other hosts."""
    rows = entry.queries()["op8_url_filter"](spark, FOLDER).collect()
    own = {r.host for r in rows if r.rule is not None}
    assert any(r.trust + r.distrust > 0 for r in rows if r.rule is None and r.host not in own)


def test_differencing():
    assert sorted(np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4]).tolist()) == [14, 16]
    draw = np.random.default_rng(3)
    for ways in (1, 2, 7, 30):
        sizes = draw.integers(1, 500, 200)
        window = packing.differencing(sizes, ways)
        sums = np.bincount(window, weights=sizes, minlength=ways)
        assert len(sums) == ways and sums.max() - sums.min() <= sizes.max()
    window = packing.windows(np.array([60, 60, 60]), 100)
    assert len(set(window.tolist())) == 3


def ids_of(text, tokenizer):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check_packing(got, texts, capacity, tokenizer):
    """Every id once, checksums right, sequences gapless and within the capacity."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, rows in by_doc.items():
        ids, at = ids_of(texts[doc], tokenizer), 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    filled = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        filled += at
    return filled, len(by_sequence)


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_packing(spark, tokenizer):
    draw = random.Random(33)
    strange = [(800 + i, "".join(chr(draw.choice([draw.randint(32, 0x24F), draw.randint(0x370, 0xD7FF), draw.randint(0xE000, 0x1FFFF),
               32, 10, 9, 39, 0x2028, 0xA0])) for _ in range(60))) for i in range(60)]
    rows = [r for r in corpus(32) if r[0] != 302] + strange + [(900, "it's they'LL 're <|endoftext|>  \n\n x  ")]
    got = packing.packed(frame(spark, rows), queries.vocabulary(), capacity=256, piece=64).collect()
    filled, sequences = check_packing(got, dict(rows), 256, tokenizer)
    assert filled > 0.97 * 256 * sequences
    twice = packing.packed(frame(spark, [(1, "a b"), (1, "a b"), (None, None)]), queries.vocabulary()).collect()
    assert sum(r.length for r in twice) == 7
    assert packing.packed(spark.createDataFrame([], SCHEMA), queries.vocabulary()).collect() == []


def test_added_tokens_have_their_ids(spark, tmp_path):
    """The query and the pipeline's stage give the ids of the default tokenizer, also for added tokens."""
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw, end = random.Random(34), "<|endoftext|>"
    rows = [(1, f"a {end} b"), (2, end), (3, f"{end}{end}x  {end}\n\n {end}"), (4, "<|endof text|> <|endoftext|"), (5, None), (6, "")]
    rows += [(10 + i, "".join(draw.choice([end, " ", "\n", "it's", " word", "é", "9"]) for _ in range(900))) for i in range(5)]
    assert packing.encode_added(queries.vocabulary())(rows[0][1]) == default.encode(rows[0][1], add_special_tokens=False).ids
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (entry.queries()["op9_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        check_packing(got.collect(), dict(rows), 2048, default)


@needs_tables
def test_pipeline(spark, tokenizer):
    """Stage by stage: only rows go, each decision takes effect, and the end holds every id that was kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        rows = docs.collect()
        assert all(r.n_chars == len(r.text) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        seen.append({r.doc_id: r.text for r in rows})
    languages, lines, near, clean = seen[1:]
    assert languages.items() <= seen[0].items() and len(languages) > 190
    assert set(lines) == set(languages) and sum(map(len, lines.values())) < sum(map(len, languages.values()))
    assert near.items() < lines.items() and clean.items() < near.items()
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert not any(b in t for b in bench for t in clean.values())
    # The registered query gives the same documents.
    got = entry.queries()["pipeline"](spark, FOLDER).collect()
    filled, sequences = check_packing(got, clean, 2048, tokenizer)
    assert filled > 0.95 * 2048 * sequences


@needs_tables
def test_registered():
    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and "op6_line_dedup" in entry.oracle_sql()
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
