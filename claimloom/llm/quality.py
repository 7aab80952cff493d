"""Document quality by weak supervision.

Rules on text statistics vote good or bad, or abstain. Nothing tells how far each rule can be
trusted; expectation-maximisation estimates that from how the rules agree, and a
document's quality is the posterior probability given all its votes.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm import textkernels as K

WINDOW = 8  # words of a window that counts as repeated
SYMBOLS = b"#*$%&|<>"
STOPS = b".!?\"')"

_is_symbol = np.zeros(256, bool)
_is_symbol[list(SYMBOLS)] = True
_is_stop = np.zeros(256, bool)
_is_stop[list(STOPS)] = True
_is_digit = np.zeros(256, bool)
_is_digit[48:58] = True
_is_letter = np.zeros(256, bool)
_is_letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_begins_point = (np.arange(256) & 0xC0) != 0x80

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stopped_lines", "n_digits",
    "n_letter_words", "n_distinct_words", "n_symbol_words",
)


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ``STATISTICS`` of each text of a block."""
    words = K.byte_words(data, offsets, lower=False)
    n_words, text = words.counts(), words.texts()
    texts = len(offsets) - 1
    inside = ~K.IS_SPACE[data]

    # Lines with a word, and how many of them differ.
    cuts = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], cuts + 1]))
    owner = np.searchsorted(offsets[1:], starts, side="right")
    # A break at the very end of a text begins an empty line of that text.
    ends = np.append(starts[1:], len(data))
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    lines = seen[ends] > seen[starts]
    starts, ends, owner = starts[lines], ends[lines], owner[lines]
    line_ends = np.where(data[ends - 1] == 10, ends - 1, ends) if len(ends) else ends
    hashes = K.span_hashes(K.BYTE_CODES[data], starts, line_ends)
    n_lines = np.bincount(owner, minlength=texts)
    distinct = K.distinct_per_text(hashes, n_lines)[1]
    last_word = np.searchsorted(words.starts, line_ends) - 1
    stopped = np.bincount(owner, weights=_is_stop[data[words.ends[last_word] - 1]], minlength=texts) if len(ends) else n_lines

    # Words in windows that occur twice in a text.
    grams = K.gram_hashes(words.hashes, WINDOW)
    at = np.flatnonzero(text[: len(grams)] == text[WINDOW - 1 :]) if len(grams) else np.zeros(0, np.int64)
    order = at[np.lexsort((grams[at], text[at]))]
    same = (grams[order[1:]] == grams[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, order[twice], 1)
    np.add.at(cover, order[twice] + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0

    def words_with(kind: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=upto[1:])
        return np.bincount(text, weights=upto[words.ends] > upto[words.starts], minlength=texts)

    return [
        n_words,
        K.count_per_text(inside & _begins_point[data], offsets),
        K.count_per_text(_is_symbol[data], offsets),
        n_lines - distinct,
        np.bincount(text, weights=repeated, minlength=texts),
        n_lines,
        stopped,
        K.count_per_text(_is_digit[data], offsets),
        words_with(_is_letter),
        K.distinct_per_text(words.hashes, n_words)[1],
        words_with(_is_symbol),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the ``STATISTICS`` (long) of every whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(1)):
                columns = [pa.array(np.asarray(c).astype(np.int64)) for c in statistics_of(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *columns], names=["doc_id", *STATISTICS]
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        measure, ", ".join(f"{c} long" for c in ("doc_id", *STATISTICS))
    )


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains. SQL on the statistics."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 50", "n_words < 30"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("symbols", "100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    Rule("symbol_share", "100 * n_symbols <= word_chars", "100 * n_symbols > 5 * word_chars"),
    Rule("symbol_words", "100 * n_symbol_words <= 2 * n_words", "100 * n_symbol_words > 20 * n_words"),
    Rule("repeated_lines", "n_dup_lines = 0 AND n_lines > 1", "10 * n_dup_lines > 3 * n_lines AND n_lines > 3"),
    Rule("repeated_words", "n_repeat_words = 0 AND n_words >= 16", "100 * n_repeat_words > 25 * n_words"),
    Rule("stops", "2 * n_stopped_lines >= n_lines AND n_lines > 0", "10 * n_stopped_lines < n_lines AND n_lines > 2"),
    Rule("digits", "100 * n_digits <= 3 * word_chars", "100 * n_digits > 15 * word_chars"),
    Rule("letters", "100 * n_letter_words >= 95 * n_words", "100 * n_letter_words < 80 * n_words"),
    Rule("variety", "10 * n_distinct_words >= 3 * n_words", "100 * n_distinct_words < 15 * n_words AND n_words >= 50"),
)


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.good), 1).when(F.expr(rule.bad), -1).otherwise(0)


@dataclass(frozen=True)
class Trust:
    """Prior of good documents and, per rule, how often a vote is right on good and on bad ones."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def weights(self, rule: int) -> tuple[float, float]:
        """Log-odds that a good vote and a bad vote add."""
        right, wrong = self.on_good[rule], self.on_bad[rule]
        return math.log(right / (1 - wrong)), math.log((1 - right) / wrong)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Trust:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts.

    Starts from rules that are right seven times in ten, so the classes keep their
    meaning; rates stay between 0.05 and 0.99 and a vote never counts for the opposite of
    what it says.
    """
    good, bad = (votes == 1).astype(float), (votes == -1).astype(float)
    on_good = np.full(votes.shape[1], 0.7)
    on_bad = on_good.copy()
    prior = 0.5
    for _ in range(rounds):
        odds = math.log(prior / (1 - prior)) + good @ np.log(on_good / (1 - on_bad)) + bad @ np.log((1 - on_good) / on_bad)
        p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        one, zero = counts * p, counts * (1 - p)
        # One document's worth of the first guess keeps rules without votes defined.
        new_good = (one @ good + 0.7) / (one @ (good + bad) + 1)
        new_bad = (zero @ bad + 0.7) / (zero @ (good + bad) + 1)
        new_good, new_bad = np.clip(new_good, 0.05, 0.99), np.clip(new_bad, 0.05, 0.99)
        new_bad = np.maximum(new_bad, 1 - new_good)
        new_prior = float(np.clip(one.sum() / max(counts.sum(), 1e-9), 0.05, 0.95))
        moved = max(np.abs(new_good - on_good).max(), np.abs(new_bad - on_bad).max(), abs(new_prior - prior))
        on_good, on_bad, prior = new_good, new_bad, new_prior
        if moved < 1e-9:
            break
    return Trust(prior, tuple(on_good.tolist()), tuple(on_bad.tolist()))


def scored(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measured`` with ``quality``, the posterior probability of a good document.

    The driver sees one row per vote pattern, at most 3 to the number of rules.
    """
    names = [f"vote_{r.name}" for r in rules]
    voted = as_table(measured.select("*", *[vote(r).alias(n) for r, n in zip(rules, names)]), "votes")
    patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("docs")).collect()
    if not patterns:
        return voted.drop(*names).withColumn("quality", F.lit(0.5))
    patterns.sort()
    table = np.array([tuple(r) for r in patterns], dtype=np.int64)
    trust = estimate(table[:, :-1], table[:, -1].astype(float))
    odds = F.lit(math.log(trust.prior / (1 - trust.prior)))
    for i, name in enumerate(names):
        up, down = trust.weights(i)
        odds = odds + F.when(F.col(name) == 1, up).when(F.col(name) == -1, down).otherwise(0.0)
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds))).drop(*names)


def judged(
    docs: DataFrame, rules: Sequence[Rule] = RULES, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Statistics, ``base_failed``, ``quality`` and ``kept`` of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` as they are written. ``base_failed``: fewer than 20
    words, or more than 30 % of the words in repeated windows. ``kept``: not that, and a
    quality of at least ``least``. A null or empty text has no words and fails. Rows with equal
    or null ids are judged each; extra columns are ignored, whatever their names. An
    empty table gives an empty result.
    """
    found = scored(statistics(docs, id_col, text_col), rules)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
