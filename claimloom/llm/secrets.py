"""Secrets in text, by one automaton for all rules.

All rules are compiled into one minimal automaton that reads every byte once and says which
stretches hold a match; stretches end at bytes that no rule uses and are walked side by
side, one array step per byte. In the few stretches that hold one, a second combined automaton reads
backwards and marks where matches of each rule begin; a rule's own automaton reads on from there to the end.
"""

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textkernels as K
from claimloom.llm.automata import Automaton

# Stretches beyond this length are walked one by one, not side by side.
LONG = 16_384

# Bytes of text walked at once: many stretches side by side, one small array each.
SCAN_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """A secret is ``prefix`` and then as many ``body`` characters as follow, at least ``least`` of them."""

    kind: str
    prefix: str
    body: str
    least: int


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        "[A-Za-z0-9+/_.=-]",
        12,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
)
# Prefixes and lengths of published key formats.
MORE_RULES = (
    Rule("key_block", "-----BEGIN ([A-Z]+ )*PRIVATE KEY", "-", 5),
    Rule("code_host", "gh[opsru]_", "[A-Za-z0-9]", 36),
    Rule("chat", "xox[abeoprs]-", "[A-Za-z0-9-]", 10),
    Rule("cloud", "AIza", "[0-9A-Za-z_-]", 35),
    Rule("payment", "[rs]k_live_", "[0-9A-Za-z]", 24),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 10),
)
RULES = BASE_RULES + MORE_RULES

Span = tuple[int, int, int]  # start, end, rule


@lru_cache(maxsize=4)
def _search(rules: tuple[Rule, ...]) -> Automaton:
    """Finds out whether a stretch holds a match of any rule.

    A prefix and one character of its body are enough to look closer, which keeps the
    automaton small; rules without a prefix count in full.
    """
    return Automaton([r.prefix + r.body + (f"{{{r.least},}}" if not r.prefix else "") for r in rules], search=True)


@lru_cache(maxsize=4)
def _begins(rules: tuple[Rule, ...]) -> tuple[list[list[int]], list[int], np.ndarray]:
    """Transitions, columns and rules of the automaton that reads backwards and marks where matches begin."""
    a = Automaton([r.prefix + r.body + "+" for r in rules], backwards=True)
    return a.next.tolist(), a.column.tolist(), a.accepts


@lru_cache(maxsize=4)
def _single(rules: tuple[Rule, ...]) -> list[tuple[Rule, list[list[int]], list[bool], list[int]]]:
    found = []
    for rule in rules:
        a = Automaton([rule.prefix + rule.body + "+"])
        found.append((rule, a.next.tolist(), a.accepts.tolist(), a.column.tolist()))
    return found


@lru_cache(maxsize=4)
def _used(rules: tuple[Rule, ...]) -> np.ndarray:
    return Automaton([r.prefix + r.body for r in rules], search=True).used


def places(text: bytes, rules: tuple[Rule, ...]) -> list[Span]:
    """Leftmost non-overlapping matches of each rule, the short ones dropped; byte offsets.

    One pass from the end marks where matches of any rule begin. Only there a rule's own automaton
    reads on, to the end of the match, so the time grows with the text and its matches.
    """
    table, column, begins = _begins(rules)
    states = array("i", bytes(4 * len(text)))
    state = 0
    for i in range(len(text) - 1, -1, -1):
        state = table[state][column[text[i]]]
        states[i] = state
    marks = begins[np.frombuffer(states, np.int32)]
    some = int(np.bitwise_or.reduce(marks)) if len(marks) else 0
    found = []
    for number, (rule, table, accepts, column) in enumerate(_single(rules)):
        if not some >> number & 1:
            continue
        starts = np.flatnonzero(marks >> number & 1)
        k, n = 0, len(text)
        while k < len(starts):
            i = j = int(starts[k])
            state, body, last = 0, -1, -1
            while j < n:
                state = table[state][column[text[j]]]
                if state < 0:
                    break
                j += 1
                if accepts[state]:
                    last = j
                    if body < 0:
                        body = j - 1
            if last - body >= rule.least:
                found.append((i, last, number))
            k = int(np.searchsorted(starts, last))
    return found


def _holds_match(text: bytes, search: Automaton) -> bool:
    """The automaton over one stretch, byte by byte."""
    table, column, accepts = search.next.tolist(), search.column.tolist(), search.accepts.tolist()
    state = 0
    for b in text:
        state = table[state][column[b]]
        if accepts[state]:
            return True
    return False


def stretches_with_match(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of a block that hold a match."""
    search = _search(rules)
    used = _used(rules)[data]
    words = K.Words(used, None, offsets)
    starts, ends = words.starts, words.ends
    lengths = ends - starts
    alone = [k for k in np.flatnonzero(lengths > LONG).tolist() if _holds_match(data[starts[k] : ends[k]].tobytes(), search)]
    long = np.array(alone, np.int64)
    walked = np.flatnonzero(lengths <= LONG)
    order = walked[np.argsort(-lengths[walked], kind="stable")]
    if not len(order):
        return starts[long], ends[long]
    columns = search.column[data]
    size = search.next.shape[1]
    # States are kept as row offsets into the flat transition array.
    table = (search.next * size).ravel()
    begin, left = starts[order], lengths[order]
    state = np.zeros(len(order), np.int32)
    alive = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
    for t, n in enumerate(alive.tolist()):
        state[:n] = table[state[:n] + columns[begin[:n] + t]]
    hit = order[search.accepts[state // size]]
    chosen = np.sort(np.concatenate([hit, long]))
    return starts[chosen], ends[chosen]


def secrets_of(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...]) -> dict[int, list[Span]]:
    """Spans of each text of a block that has any, in code points, by start and rule."""
    found: dict[int, list[Span]] = {}
    starts, ends = stretches_with_match(data, offsets, rules)
    if not len(starts):
        return found
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    for start, end, text in zip(starts.tolist(), ends.tolist(), owner.tolist()):
        zero = points[offsets[text]]
        for a, b, rule in places(data[start:end].tobytes(), rules):
            found.setdefault(text, []).append((int(points[start + a] - zero), int(points[start + b] - zero), rule))
    for spans in found.values():
        spans.sort(key=lambda s: (s[0], s[2]))
    return found


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, base: int = len(BASE_RULES), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Secrets of every document.

    Returns ``doc_id``, a count ``n_<kind>`` (long) for each of the first ``base`` rules,
    ``base_sha256`` (of their spans as ``kind:start:end``, joined by commas, in lowercase hex) and
    ``spans`` (the spans of all rules as text). Spans are in code points, end exclusive,
    ordered by start and rule. A null or empty text has none. Rows with equal or null ids are scanned
    each; extra columns are ignored, whatever their names. An empty table gives an empty result.
    """
    rules = tuple(rules)
    counted = [f"n_{r.kind}" for r in rules[:base]]
    nothing = hashlib.sha256(b"").hexdigest()

    def text_of(spans: list[Span]) -> str:
        return ",".join(f"{rules[r].kind}:{a}:{b}" for a, b, r in spans)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(1), SCAN_BYTES):
                n = end - first
                counts = np.zeros((base, n), np.int64)
                digests, spans = [nothing] * n, [""] * n
                for text, own in secrets_of(data, offsets, rules).items():
                    spans[text] = text_of(own)
                    basic = [s for s in own if s[2] < base]
                    for _, _, rule in basic:
                        counts[rule, text] += 1
                    digests[text] = hashlib.sha256(text_of(basic).encode()).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), *[pa.array(c) for c in counts], pa.array(digests), pa.array(spans)],
                    names=["doc_id", *counted, "base_sha256", "spans"],
                )

    schema = ", ".join(["doc_id long", *[f"{c} long" for c in counted], "base_sha256 string", "spans string"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        find, schema
    )
