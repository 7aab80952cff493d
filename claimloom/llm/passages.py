"""Repeated passages inside documents, by paragraph MinHash.

Paragraphs are the lines of a text. Their shingles are banded for high recall, colliding
paragraphs are joined and checked by exact Jaccard, and the components of the links are the
passages. A passage that sits inside a longer paragraph shares no line with
its copies, so a text is also cut by its content: windows of words that begin at
anchors, words whose hash is the smallest around. Equal texts have equal anchors
wherever they stand, so each of their common stretches holds equal windows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm import minhash
from claimloom.llm import textkernels as K

SHINGLE = 5

# Words of a window, and of the shortest paragraph.
WINDOW = 16

# Each run of so many 3-word grams holds an anchor: a common stretch of
# ANCHOR + WINDOW + 1 = 49 words holds a whole common window.
ANCHOR = 32

# 6 bands of 2 values: a pair of similarity 0.8 is missed with probability (1 - 0.8^2)^6 < 0.003.
BANDS, ROWS = 6, 2

UNITS = "doc_id long, text_hash long, start int, end int, paragraph boolean, content long, keys array<long>"


def paragraphs(data: np.ndarray, words: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end word of each line with at least ``WINDOW`` words."""
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    line, text = breaks[words.starts], words.texts()
    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (text[1:] != text[:-1])]))
    end = np.append(first[1:], len(line))
    long = end - first >= WINDOW
    return first[long], end[long]


def windows(words: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end word of each window that begins at an anchor."""
    text = words.texts()
    grams = K.gram_hashes(words.hashes, 3)
    if len(grams) < ANCHOR:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = K.sliding(np.minimum, grams, ANCHOR)
    # Only runs inside one text count; a hash of 0 is no anchor.
    least[text[: len(least)] != text[ANCHOR + 1 :]] = 0
    around = np.concatenate([np.zeros(ANCHOR - 1, np.uint64), least, np.zeros(ANCHOR - 1, np.uint64)])
    first = np.flatnonzero((K.sliding(np.maximum, around, ANCHOR) == grams) & (grams > 0))
    first = first[first + WINDOW <= len(text)]
    first = first[text[first] == text[first + WINDOW - 1]]
    return first, first + WINDOW


def _contents(words: K.Words, first: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    return K.mix(K.span_hashes(words.hashes, first, end) + np.uint64(salt))


def _shingles(words: K.Words, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each run of words, and their numbers."""
    grams = K.gram_hashes(words.hashes, SHINGLE)
    counts = end - first - SHINGLE + 1
    return K.distinct_per_text(grams[K.ragged(first, counts)], counts)


def _find_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = K.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        for low, high, data, offsets in K.blocks(batch.column(2)):
            words = K.byte_words(data, offsets)
            text = words.texts()
            first, end = paragraphs(data, words)
            keys = np.zeros((len(first), BANDS), np.uint64)
            if len(first):
                shingles, counts = _shingles(words, first, end)
                short = (shingles >> np.uint64(32)).astype(np.uint32)
                bounds = np.cumsum(counts) - counts
                for b in range(BANDS):
                    # One permutation per band; its smallest and largest value are the rows.
                    hashed = short * minhash.FACTORS[b]
                    for how in (np.minimum, np.maximum):
                        keys[:, b] = K.mix(keys[:, b] + how.reduceat(hashed, bounds).astype(np.uint64) + np.uint64(1))
                keys += salt
            w_first, w_end = windows(words)
            content = np.concatenate([_contents(words, first, end, 1), _contents(words, w_first, w_end, 2)])
            many = np.concatenate([np.full(len(first), BANDS), np.zeros(len(w_first), np.int64)])
            all_first, all_end = np.concatenate([first, w_first]), np.concatenate([end, w_end])
            owner = text[all_first] if len(all_first) else np.zeros(0, np.int64)
            ends = np.zeros(len(many) + 1, np.int32)
            ends[1:] = np.cumsum(many)
            rows = pa.array(owner + low)
            starts = words.starts[all_first] if len(all_first) else owner
            stops = words.ends[all_end - 1] if len(all_first) else owner
            # Only a paragraph's text is read again, so only it needs the text's hash.
            known = pa.array(np.repeat([False, True], [len(first), len(w_first)]))
            hashes = batch.column(1).take(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    pa.compute.if_else(known, 0, hashes) if len(hashes) else hashes,
                    pa.array((starts - offsets[owner]).astype(np.int32)),
                    pa.array((stops - offsets[owner]).astype(np.int32)),
                    pa.compute.invert(known),
                    pa.array(content.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64))),
                ],
                names=[part.split()[0] for part in UNITS.split(", ")],
            )


def _fetch_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the wanted paragraphs; copies of a text in one task are read once."""
    seen: set[int] = set()
    for batch in batches:
        contents, sets = [], []
        for text_hash, text, wanted in zip(*[batch.column(i) for i in range(3)]):
            if text_hash.as_py() in seen:
                continue
            seen.add(text_hash.as_py())
            data = text.as_py().encode()
            for w in wanted.as_py():
                part = np.frombuffer(data[w["start"] : w["end"]], np.uint8)
                words = K.byte_words(part, np.array([0, len(part)]))
                contents.append(w["content"])
                sets.append(_shingles(words, np.array([0]), np.array([len(words.starts)]))[0].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(contents, pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "shingles"]
        )


def repeated_passages(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages that occur more than once, per document.

    Lines of at least ``WINDOW`` words are linked when 100 * |intersection| >= percent *
    |union| of their five-word shingles; windows of words when they are equal. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and equal 64-bit hashes of their sequence
    count as equal. Any common stretch of at least ``ANCHOR + WINDOW + 1`` words is found
    wherever it stands. Returns a row for each document that holds such a passage: ``doc_id``, ``n_passages``,
    ``n_removed`` (long; all but the first occurrence of a passage go, in the order of
    document and place), ``passages`` (component, byte range in the text and ``kept`` of each).

    A null or empty text holds nothing. Rows with equal ids count as one document; rows with a
    null id share one, too. Extra columns are ignored, whatever their names. An empty
    table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    units = as_table(texts.mapInArrow(_find_units, UNITS), "units")
    lines = units.filter("paragraph")
    classes = as_table(
        lines.groupBy(F.col("content").alias("rep")).agg(
            F.first("keys").alias("keys"), F.min(F.struct("text_hash", "start", "end")).alias("where")
        ),
        "paragraphs",
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        spots = classes.join(wanted, "rep", "left_semi").groupBy("where.text_hash").agg(
            F.collect_list(F.struct(F.col("rep").alias("content"), "where.start", "where.end")).alias("wanted")
        )
        found = texts.select("text_hash", "text").join(spots, "text_hash").select("text_hash", "text", "wanted")
        return found.mapInArrow(_fetch_shingles, "doc_id long, shingles binary")

    labels = minhash.linked_classes(classes.select("rep", "keys"), sets_of, percent)

    # A passage is a component of paragraphs, or one window; those that occur twice matter.
    counts = units.groupBy("content").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(labels.withColumnRenamed("node", "content"), "content", "left")
    # Stored, so that the join can split a passage that is almost everywhere.
    repeated = as_table(
        named.filter("n > 1 OR label IS NOT NULL").select("content", F.coalesce("label", "content").alias("component")),
        "repeated-contents",
    )
    found = as_table(
        units.drop("keys", "text_hash").join(repeated, "content").drop("content"),
        "repeated",
    )
    keepers = found.groupBy("component").agg(F.min(F.struct("doc_id", "start")).alias("keeper"))
    marked = found.join(as_table(keepers, "keepers"), "component").select(
        "doc_id", "component", "start", "end", F.struct("doc_id", "start").eqNullSafe(F.col("keeper")).alias("kept")
    )
    return marked.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_passages"),
        F.sum((~F.col("kept")).cast("long")).alias("n_removed"),
        F.sort_array(F.collect_list(F.struct("start", "end", "component", "kept"))).alias("passages"),
    )
