"""Importance resampling towards the word statistics of a target corpus.

Words and pairs of consecutive words are features, hashed by CRC-32 into buckets. How much more often the
target fills a bucket than the corpus is the bucket's gain; a document weighs the mean gain of its
features, and Gumbel noise from its id turns the heaviest documents into a sample.

The vocabulary is split into head and tail. For the most frequent words their exact CRC states are broadcast, from
which the CRC of any pair that begins with them continues, and for the most frequent pairs
their buckets. Other words and pairs are hashed directly. Both ways give the same bucket, so which
features belong to the head decides about speed only.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm.textkernels import LOWER, Words, blocks

IS_WORD = np.zeros(256, bool)
IS_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True

# The head: bounds of what is broadcast.
HEAD_WORDS = 16_384
HEAD_PAIRS = 131_072
HEAD_WORD_BYTES = 64
PAIR_SLOTS = 1 << 19
# A task reports the features that make up at least this part of its words, and counts so many at a
# time. Counts fall short by at most 2 / COUNTED of the features and HEAD_ERROR of the words read.
HEAD_ERROR = 1 / 200_000
COUNTED = 400_000
# Bytes of text that are handled at a time.
SLICE_BYTES = 4_000_000
SPACE = np.array([32], np.uint8)


@dataclass(frozen=True)
class Run:
    """Words of consecutive rows, or of a piece of a long text: ``words[at]`` in order.

    ``first[t]`` .. ``first[t + 1]`` are the words of row ``row + t``. From the second piece of a text on, the word before
    leads the run again (``led``) and counts in its pair only.
    """

    row: int
    words: pa.BinaryArray
    at: np.ndarray
    first: np.ndarray
    led: bool

    def texts(self) -> list[bytes]:
        return self.words.to_numpy(zero_copy_only=False).tolist()

    def pairs(self) -> np.ndarray:
        """Places of the words that have a next word in their text."""
        inner = np.ones(len(self.at), bool)
        inner[self.first[1:][self.first[1:] > 0] - 1] = False
        return np.flatnonzero(inner)


def piece_ends(inside: np.ndarray) -> list[int]:
    """Ends of pieces of about ``SLICE_BYTES``, none of them inside a word."""
    ends, breaks, at = [], np.flatnonzero(~inside), SLICE_BYTES
    while at < len(inside) and (place := np.searchsorted(breaks, at)) < len(breaks):
        ends.append(int(breaks[place]))
        at = ends[-1] + SLICE_BYTES
    return [*ends, len(inside)]


def runs(column: pa.Array) -> Iterator[Run]:
    """The words of a text column, A-Z lower-cased, in runs of about ``SLICE_BYTES``."""
    for row, _, data, offsets in blocks(column, SLICE_BYTES):
        data, start, last = LOWER[data], 0, None
        long = len(offsets) == 2 and len(data) > SLICE_BYTES
        for end in piece_ends(IS_WORD[data]) if long else [len(data)]:
            piece, start = data[start:end], end
            if last is not None:
                piece = np.concatenate([last, SPACE, piece])
            inside = IS_WORD[piece]
            words = Words(inside, None, np.array([0, len(piece)]) if long else offsets)
            if len(words.starts) == (last is not None):
                continue
            ends = np.cumsum(words.ends - words.starts).astype(np.int32)
            buffers = [None, pa.py_buffer(np.r_[np.int32(0), ends]), pa.py_buffer(piece[inside])]
            coded = pa.Array.from_buffers(pa.binary(), len(ends), buffers).dictionary_encode()
            yield Run(row, coded.dictionary, coded.indices.to_numpy(), words.first, last is not None)
            last = piece[words.starts[-1] : words.ends[-1]]


@dataclass(frozen=True)
class Head:
    """CRC states of frequent words, and a table of frequent pairs by slot.

    A pair's code is ``first * len(words) + second``. Each slot holds one pair; a pair whose slot is
    taken by a more frequent one is hashed like the tail.
    """

    words: pa.BinaryArray
    states: np.ndarray
    pairs: np.ndarray
    buckets: np.ndarray

    @staticmethod
    def slot(codes: np.ndarray, slots: int) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) % slots

    @classmethod
    def of(cls, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> "Head":
        """``words`` and ``pairs`` in order of frequency; pairs of other words are left out."""
        index = {w: i for i, w in enumerate(words)}
        inside = [(a, b) for a, b in pairs if a in index and b in index]
        codes = np.array([index[a] * len(words) + index[b] for a, b in inside], np.int64)
        place = np.array([zlib.crc32(a + b" " + b) % buckets for a, b in inside], np.int32)
        slots = max(1, min(PAIR_SLOTS, 4 * len(codes)))
        table, at = np.full(slots, -1, np.int64), np.zeros(slots, np.int32)
        # Backwards, so that the more frequent pair is written last.
        where = cls.slot(codes, slots)[::-1]
        table[where], at[where] = codes[::-1], place[::-1]
        return cls(pa.array(words, pa.binary()), np.array([zlib.crc32(w) for w in words], np.int64), table, at)

    def features(self, run: Run, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all words and of all pairs of a run, and the place of each pair's first word."""
        index = pc.fill_null(pc.index_in(run.words, value_set=self.words), -1).to_numpy().astype(np.int64)
        states = self.states[index] if len(self.states) else np.zeros(len(index), np.int64)
        texts = run.texts()
        tail = np.flatnonzero(index < 0).tolist()
        states[tail] = [zlib.crc32(texts[i]) for i in tail]
        place = run.pairs()
        first, second = run.at[place], run.at[place + 1]
        head = index[first], index[second]
        codes = head[0] * len(self.words) + head[1]
        slot = self.slot(codes, len(self.pairs))
        pairs = self.buckets[slot].astype(np.int64)
        rest = np.flatnonzero((self.pairs[slot] != codes) | (head[0] < 0) | (head[1] < 0))
        if len(rest):
            # The CRC goes on from the first word's state.
            following = [b" " + w for w in texts]
            seconds = map(following.__getitem__, second[rest].tolist())
            crcs = np.fromiter(map(zlib.crc32, seconds, states[first[rest]].tolist()), np.int64, len(rest))
            pairs[rest] = crcs % buckets
        return (states % buckets)[run.at], pairs, place


def _texts(docs: DataFrame, text_col: str, *columns) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"), *columns)


class Counts:
    """Misra-Gries counts of words and pairs: the smallest are given up where there are too many."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.words = np.zeros(0, np.int64)
        # Pairs as first << 32 | second, ascending.
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, run: Run) -> None:
        known = self.index
        names = np.array([known.setdefault(w, len(known)) for w in run.texts()], np.int64)
        words = np.zeros(len(known), np.int64)
        words[: len(self.words)] = self.words
        words += np.bincount(names[run.at[int(run.led) :]], minlength=len(known))
        self.words = words
        place = run.pairs()
        codes = (names[run.at[place]] << 32) | names[run.at[place + 1]]
        self.waiting.append(np.unique(codes, return_counts=True))
        if sum(len(codes) for codes, _ in self.waiting) > COUNTED or len(known) > COUNTED:
            self.settle()

    def settle(self) -> None:
        """Add up what waits and keep to the bounds."""
        codes, times = (np.concatenate(x) for x in zip((self.pairs, self.times), *self.waiting))
        self.waiting = []
        order = np.argsort(codes, kind="stable")
        codes, times = codes[order], times[order]
        new = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
        self.pairs, self.times = codes[new], np.add.reduceat(times, new) if len(new) else times
        if len(self.words) > COUNTED:
            self._shorten_words()
        if len(self.pairs) > COUNTED:
            least = _lowered_by(self.times)
            kept = self.times > least
            self.pairs, self.times = self.pairs[kept], self.times[kept] - least

    def _shorten_words(self) -> None:
        """A pair is given up with its words: it was not more frequent than they were."""
        least = _lowered_by(self.words)
        kept = self.words > least
        number = np.cumsum(kept) - 1
        self.index = {w: int(number[i]) for w, i in self.index.items() if kept[i]}
        self.words = self.words[kept] - least
        first, second = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        both = kept[first] & kept[second]
        codes = (number[first[both]] << 32) | number[second[both]]
        # Numbers keep their order, so codes do.
        self.pairs, self.times = codes, self.times[both]


def _lowered_by(counts: np.ndarray) -> int:
    """The count that half of the places lie above."""
    return int(np.partition(counts, len(counts) - COUNTED // 2)[len(counts) - COUNTED // 2])


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words and pairs of what the task reads, as (first, second or null, count)."""
    counts, total = Counts(), 0
    for batch in batches:
        for run in runs(batch.column(0)):
            counts.add(run)
            total += len(run.at)
    counts.settle()
    words = list(counts.index)
    short = np.array([len(w) <= HEAD_WORD_BYTES for w in words], bool)
    singles = np.flatnonzero(short & (counts.words >= total * HEAD_ERROR))
    first, second = counts.pairs >> 32, counts.pairs & 0xFFFFFFFF
    pairs = np.flatnonzero((counts.times >= total * HEAD_ERROR) & short[first] & short[second])
    names = pa.array(words, pa.binary())
    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([names.take(pa.array(singles)), names.take(pa.array(first[pairs]))]),
            pa.concat_arrays([pa.nulls(len(singles), pa.binary()), names.take(pa.array(second[pairs]))]),
            pa.array(np.concatenate([counts.words[singles], counts.times[pairs]])),
        ],
        names=["first", "second", "n"],
    )


def frequent(docs: DataFrame, buckets: int, text_col: str = "text") -> Head:
    """The head vocabulary of a corpus; its size has a fixed bound."""
    found = _texts(docs, text_col).mapInArrow(count_features, "first binary, second binary, n long")
    counts = as_table(found.groupBy("first", "second").agg(F.sum("n").alias("n")), "frequent-features")

    def top(rows: DataFrame, most: int) -> list:
        return rows.orderBy(F.desc("n"), "first", "second").limit(most).collect()

    words = top(counts.filter("second IS NULL"), HEAD_WORDS)
    pairs = top(counts.filter("second IS NOT NULL"), HEAD_PAIRS)
    return Head.of([bytes(r["first"]) for r in words], [(bytes(r["first"]), bytes(r["second"])) for r in pairs], buckets)


def bucket_totals(docs: DataFrame, head: Head, buckets: int, text_col: str = "text") -> DataFrame:
    """``bucket`` and ``n``, the features of all documents in it; buckets without features have no row."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, known = np.zeros(buckets, np.int64), shared.value
        for batch in batches:
            for run in runs(batch.column(0)):
                words, pairs, _ = known.features(run, buckets)
                totals += np.bincount(words[int(run.led) :], minlength=buckets) + np.bincount(pairs, minlength=buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["bucket", "n"])

    found = _texts(docs, text_col).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of how much more often the target fills each bucket, from the totals of both."""
    filled = [{r["bucket"]: r["n"] for r in totals.collect()} for totals in (corpus, target)]
    (s, t), (all_s, all_t) = filled, (sum(f.values()) for f in filled)
    gains = [
        log((t.get(b, 0) + 1.0) * (all_s + float(buckets)) / ((s.get(b, 0) + 1.0) * (all_t + float(buckets))))
        for b in range(buckets)
    ]
    return np.floor(1000 * np.array(gains)).astype(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def weights(docs: DataFrame, head: Head, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the floored mean gain, of each document."""
    buckets = len(gains)
    shared = docs.sparkSession.sparkContext.broadcast((head, gains))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = shared.value
        for batch in batches:
            n_words, n_pairs, total = np.zeros((3, batch.num_rows), np.int64)
            for run in runs(batch.column(0)):
                words, pairs, place = known.features(run, buckets)
                gains_of_words, gains_of_pairs = gain[words], gain[pairs]
                if run.led:
                    gains_of_words[0] = 0
                bounds = np.searchsorted(place, run.first)
                rows = slice(run.row, run.row + len(run.first) - 1)
                n_words[rows] += np.diff(run.first) - run.led
                n_pairs[rows] += np.diff(bounds)
                total[rows] += _sums(gains_of_words, run.first) + _sums(gains_of_pairs, bounds)
            n_features = n_words + n_pairs
            weight = total // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *map(pa.array, (n_words, n_features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = _texts(docs, text_col, F.col(id_col).cast("long").alias("doc_id"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int, id_col: str = "doc_id"):
    """floor(1000 x Gumbel noise) from a hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(scored: DataFrame, eligible, numerator: int, denominator: int) -> DataFrame:
    """Add ``rank`` to the ``numerator / denominator`` of the eligible rows with the highest ``score``.

    Ties go to the smaller ``doc_id``. Scores are whole numbers that noise spreads over thousands of
    values, so rows are ordered within each value only; a value holds a small share of any corpus.
    """
    scored = as_table(scored.withColumn("eligible", F.coalesce(eligible, F.lit(False))), "scored")
    per_score = scored.filter("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # One row per value: gains and noise bound how many there can be.
    upto = Window.orderBy(F.desc("score"))
    marks = per_score.select(
        "score",
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.floor(F.sum("n").over(Window.partitionBy()) * numerator / denominator).alias("drawn"),
    )
    marks = as_table(marks.filter("before < drawn"), "ranks")
    cut = marks.agg(F.min("score")).first()[0]
    above = F.col("eligible") & (F.col("score") >= F.lit(cut).cast("long"))
    within = Window.partitionBy("score").orderBy("doc_id", "n_features")
    place = F.row_number().over(within).cast("long")
    drawn = scored.filter(above).withColumn("place", place).join(F.broadcast(marks), "score")
    number = F.col("before") + F.col("place")
    drawn = drawn.withColumn("rank", F.when(number <= F.col("drawn"), number))
    rest = scored.filter(~F.coalesce(above, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    columns = [*(c for c in scored.columns if c != "eligible"), "rank"]
    return drawn.select(*columns).unionByName(rest.select(*columns))


def resampled(
    docs: DataFrame, target: DataFrame, numerator: int = 25, denominator: int = 100, least_words: int = 20,
    buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Weight, score and place of every document of ``docs`` in a sample that resembles ``target``.

    A-Z are lower-cased and words are runs of digits, a-z and characters beyond ASCII; features are words
    and pairs of consecutive words, repeats counted. Returns ``doc_id``, ``n_words``, ``n_features``, ``weight``
    (floored mean gain, 0 without features), ``score`` (weight and noise) and ``rank``: 1, 2, 3 ... for the drawn
    part of the documents with at least ``least_words`` words, else null.

    A null or empty text has no features. Ties go to the smaller id; rows with equal ids are
    documents of their own. A row without an id counts in the corpus but has no score and is never
    drawn. With an empty target all gains come from the corpus alone. Columns other than id and text are ignored,
    whatever their names. An empty table gives an empty result.
    """
    head = frequent(docs, buckets, text_col)
    gains = bucket_gains(
        bucket_totals(docs, head, buckets, text_col), bucket_totals(target, head, buckets, text_col), buckets
    )
    scored = weights(docs, head, gains, id_col, text_col).withColumn("score", F.col("weight") + noise(seed))
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    return ranked(scored, eligible, numerator, denominator)


def sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, with all columns; see :func:`resampled`."""
    drawn = resampled(docs, target, id_col=id_col, **settings).filter("rank IS NOT NULL")
    ids = as_table(drawn.select(F.col("doc_id").alias("__drawn")).distinct(), "drawn")
    return docs.join(ids, docs[id_col].cast("long") == ids["__drawn"], "left_semi")
