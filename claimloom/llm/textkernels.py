"""Vectorised helpers on the raw bytes of Arrow text columns.

Every helper takes one block: the concatenated UTF-8 bytes of some texts and the
offsets between them. Words, lines and windows of all texts of a block are found and
hashed at once, so the cost per byte does not depend on how long the texts are.
Nothing here knows about Spark; the operators call it inside ``mapInArrow``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1_000_000

SPACES = b" \t\n\x0b\x0c\r"

_random = np.random.Generator(np.random.PCG64(20240917))
BYTE_CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection whose output bits all depend on all input bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about ``most`` bytes: first row, end row, bytes, offsets."""
    data, offsets = column_bytes(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class Words:
    """Words of a block: runs of characters that are ``inside``, never crossing texts.

    ``codes`` is a 64-bit code per character; a word's hash is a polynomial in them.
    Without codes the words are not hashed.
    """

    def __init__(self, inside: np.ndarray, codes: np.ndarray | None, offsets: np.ndarray):
        before = np.empty(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(inside)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(inside), dtype=bool)
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        # first[t] .. first[t + 1] are the words of text t
        self.first = np.searchsorted(self.starts, offsets)
        if codes is not None:
            self.hashes = span_hashes(codes, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def byte_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``, with A-Z lower-cased if asked."""
    return Words(~IS_SPACE[data], BYTE_CODES[LOWER[data] if lower else data], offsets)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial in its codes, mixed with its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    if len(starts):
        bounds = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(bounds, lengths)
        terms = codes[place + np.repeat(starts, lengths)]
        terms *= powers(BASE, int(lengths.max()))[place]
        out[some] = mix(np.add.reduceat(terms, bounds) ^ lengths.astype(np.uint64))
    return out


def count_per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of marked characters of each text."""
    upto = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=upto[1:])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive hashes."""
    size = max(len(hashes) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = mix(out + hashes[i : i + size] + np.uint64(i + 1))
    return out


def ragged(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0]+1, ... (counts[0] numbers), firsts[1], ... as one array."""
    counts = np.asarray(counts, dtype=np.int64)
    bounds = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(bounds, counts) + np.repeat(firsts, counts)


def text_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles of each text, and the number of shingles per text.

    A text with fewer words is one shingle of all its words; one without words has none.
    """
    counts = words.counts()
    grams = gram_hashes(words.hashes, n)
    per_text = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    per_text[short] = 1
    out = np.empty(int(per_text.sum()), np.uint64)
    bounds = np.cumsum(per_text) - per_text
    long = counts >= n
    out[ragged(bounds[long], per_text[long])] = grams[ragged(words.first[:-1][long], per_text[long])]
    for t in short:
        whole = words.hashes[words.first[t] : words.first[t + 1]]
        value = np.zeros(1, np.uint64)
        for i, h in enumerate(whole):
            value = mix(value + h + np.uint64(1000 * n + i + 1))
        out[bounds[t]] = value[0]
    return out, per_text


def distinct_per_text(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, and their number."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.bincount(text[new], minlength=len(counts)).astype(np.int64)


def sliding(how: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``how`` (minimum or maximum) of each ``width`` consecutive unsigned values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    # Never wins inside a whole window: windows do not reach into the padding.
    rows = np.concatenate([values, np.zeros(-len(values) % width, values.dtype)]).reshape(-1, width)
    ahead = how.accumulate(rows, axis=1).ravel()
    back = how.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    # A window is the end of one row and the beginning of the next.
    return how(back[:n], ahead[width - 1 : width - 1 + n])
