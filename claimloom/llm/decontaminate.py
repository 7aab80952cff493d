"""Benchmark passages in documents, by greedy string tiling.

Documents and test items that share runs of tokens (seeds) are compared by greedy string
tiling: the longest common run that is still free on both sides is marked as a tile, again and
again, until no free run reaches the least length. Tiles may come in any order, so
a passage whose parts were moved is still covered. The share of an item's tokens that lies
under tiles decides.

The test set is the query set: its rows are read in blocks of bounded size, and every
document is compared with every block, so neither side has to fit anywhere as a whole.
"""

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textkernels as K

# Tokens of the shortest tile.
LEAST = 5

# Runs that are made Python numbers at once.
TILE_ROWS = 50_000

# Characters of test items that are held in memory at once.
BLOCK_CHARS = 8_000_000


@lru_cache(maxsize=1)
def _points() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it belongs to a token, and its code."""
    token = np.zeros(0x110000, bool)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            token[code] = chr(code).isalnum()
    return token, K.mix(np.arange(1, 0x110001, dtype=np.uint64))


def tokens(texts: list[str]) -> K.Words:
    """Lower-cased runs of letters and digits of each text."""
    token, codes = _points()
    coded = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(c) for c in coded], out=offsets[1:])
    flat = np.concatenate([*coded, np.zeros(0, np.uint32)])
    return K.Words(token[flat], codes[flat], offsets)


# Maximal common runs that are listed at once; a text with more is handled on its own.
MOST_RUNS = 2_000_000

# Stand for the token before the first or after the last of a document and of an item; they equal nothing.
_NO_TOKEN, _NO_ITEM_TOKEN = np.uint64(1), np.uint64(2)


def _beside(words: K.Words, owner: np.ndarray, at: np.ndarray, step: int, nothing: np.uint64) -> np.ndarray:
    """The token one before (``step`` -1) or after the five at each place, or ``nothing`` at the text's edge."""
    edge = at if step < 0 else at + LEAST - 1
    beside = np.clip(edge + step, 0, max(len(owner) - 1, 0))
    inside = (edge + step == beside) & (owner[beside] == owner[edge])
    return np.where(inside, words.hashes[beside], nothing)


def _pair_codes(number: np.ndarray, beside: np.ndarray) -> np.ndarray:
    return K.mix(number.astype(np.uint64) + np.uint64(1)) ^ beside


class Side:
    """Places of items' five-token runs by their hash and the token beside them.

    Equal runs of a document and an item that have equal tokens beside them continue there. So the
    places at which a common run begins (or ends) are those of the same hash but for the ones of the
    same token, which lie together: only these places are listed, not all pairs of equal runs.
    """

    def __init__(self, grams: np.ndarray, places: np.ndarray, beside: np.ndarray):
        order = np.lexsort((beside, grams))
        self.places = places[order]
        grams, beside = grams[order], beside[order]
        self.hashes, self.first = np.unique(grams, return_index=True)
        self.last = np.append(self.first[1:], len(grams))
        number = np.repeat(np.arange(len(self.hashes)), self.last - self.first)
        codes = _pair_codes(number, beside)
        self.by_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.by_code]

    def counts(self, number: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per document place: first and end of its hash, and of the part that continues."""
        low, high = self.first[number], self.last[number]
        codes = _pair_codes(number, beside)
        begin = np.searchsorted(self.codes, codes, side="left")
        many = np.searchsorted(self.codes, codes, side="right") - begin
        skip = np.where(many > 0, self.by_code[np.minimum(begin, len(self.codes) - 1)], high)
        skip = np.clip(skip, low, high)
        return low, skip, np.clip(skip + many, skip, high), high

    def list(self, at: np.ndarray, ranges: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Document places and item places of all that does not continue."""
        low, skip, resume, high = ranges
        left, right = skip - low, high - resume
        return (
            np.concatenate([np.repeat(at, left), np.repeat(at, right)]),
            self.places[np.concatenate([K.ragged(low, left), K.ragged(resume, right)])],
        )


class Items:
    """Test items with an index of their runs of ``LEAST`` tokens."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [i for i, _ in rows]
        words = tokens([t or "" for _, t in rows])
        self.first, self.hashes = words.first, words.hashes
        self.owner = owner = words.texts()
        grams = K.gram_hashes(words.hashes, LEAST)
        whole = np.flatnonzero(owner[: len(grams)] == owner[LEAST - 1 :]) if len(grams) else np.zeros(0, np.int64)
        self.begins = Side(grams[whole], whole, _beside(words, owner, whole, -1, _NO_ITEM_TOKEN))
        self.ends = Side(grams[whole], whole, _beside(words, owner, whole, 1, _NO_ITEM_TOKEN))
        self.grams = self.begins.hashes
        # A cheap first look: the top 20 bits of the hashes that occur.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.grams >> np.uint64(44)] = True

    def runs(self, words: K.Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Maximal common runs: places in the documents' words and in the items' words, lengths.

        They come in parts of whole texts, each of at most ``MOST_RUNS`` or of a single text.
        """
        grams = K.gram_hashes(words.hashes, LEAST)
        at = np.flatnonzero(self.maybe[grams >> np.uint64(44)])
        number = np.searchsorted(self.grams, grams[at])
        known = number < len(self.grams)
        at, number = at[known], number[known]
        owner = words.texts()
        known = (self.grams[number] == grams[at]) & (owner[at] == owner[at + LEAST - 1])
        at, number = at[known], number[known]
        if not len(at):
            return
        begin = self.begins.counts(number, _beside(words, owner, at, -1, _NO_TOKEN))
        end = self.ends.counts(number, _beside(words, owner, at, 1, _NO_TOKEN))
        runs = (begin[1] - begin[0]) + (begin[3] - begin[2])
        edges = np.flatnonzero(np.diff(owner[at], prepend=-1))
        upto = np.append(np.cumsum(runs) - runs, runs.sum())
        edges = np.append(edges, len(at))
        low = 0
        while low < len(edges) - 1:
            high = max(low + 1, int(np.searchsorted(upto[edges], upto[edges[low]] + MOST_RUNS, side="right")) - 1)
            part = slice(edges[low], edges[high])
            yield self._joined(
                self.begins.list(at[part], tuple(r[part] for r in begin)), self.ends.list(at[part], tuple(r[part] for r in end))
            )
            low = high

    def _joined(self, begins, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings with the next end on their diagonal."""
        (p, q), (p_end, q_end) = begins, ends
        size = int(max(p.max(initial=0), p_end.max(initial=0))) + 2
        shift = len(self.owner)
        keys = (p - q + shift) * size + p
        order = np.argsort(keys)
        p, q, keys = p[order], q[order], keys[order]
        closing = np.append(np.sort((p_end - q_end + shift) * size + p_end), np.iinfo(np.int64).max)
        end = closing[np.searchsorted(closing, keys)]
        # Without an end of its own (unequal tokens of equal hash) a run has the least length; tiling compares it.
        length = np.where(end // size == keys // size, end - keys, 0) + LEAST
        return p, q, length


def tiles(left: np.ndarray, right: np.ndarray, p: np.ndarray, q: np.ndarray, length: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``right`` by ``left``: (place in left, place in right, length).

    ``p``, ``q`` and ``length`` are the maximal equal runs of at least ``LEAST`` hashes. The longest is
    marked first, the earliest among equals, and what is left of a run that overlaps a tile waits for
    its turn. It ends when ``right`` has no free run of ``LEAST`` hashes.
    """
    order = np.lexsort((p, q, -length))
    given = (
        run
        for k in range(0, len(order), TILE_ROWS)
        for run in zip(*(x[order[k : k + TILE_ROWS]].tolist() for x in (-length, q, p)))
    )
    used_left, used_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
    found: list[tuple[int, int, int]] = []
    rest: list[tuple[int, int, int]] = []  # pieces of runs, a heap
    head, wasted = next(given, None), 0
    while head or rest:
        if rest and (not head or rest[0] < head):
            n, b, a = heapq.heappop(rest)
        else:
            (n, b, a), head = head, next(given, None)
        n = -n
        free = ~(used_left[a : a + n] | used_right[b : b + n])
        if free.all():
            if (left[a : a + n] == right[b : b + n]).all():
                used_left[a : a + n] = used_right[b : b + n] = True
                found.append((a, b, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        pieces = [(x, y) for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()) if y - x >= LEAST]
        for start, end in pieces:
            heapq.heappush(rest, (start - end, b + start, a + start))
        wasted += not pieces
        if not pieces and wasted & (wasted - 1) == 0:  # looked at 1, 2, 4, 8, ... times
            edge = np.flatnonzero(np.diff(np.concatenate([[1], used_right.view(np.int8), [1]])))
            if not len(edge) or np.diff(edge)[::2].max() < LEAST:
                break
    return found


def leaks_of(texts: list[str], items: Items, threshold: float) -> list[tuple[int, int, int, int, int]]:
    """(text, item, covered tokens, item's tokens, tiles) of the texts that cover an item."""
    words = tokens(texts)
    owner = words.texts()
    found = []
    for at, place, length in items.runs(words):
        text, item = owner[at], items.owner[place]
        order = np.lexsort((item, text))
        at, place, length, text, item = at[order], place[order], length[order], text[order], item[order]
        cuts = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            t, i = int(text[start]), int(item[start])
            size = int(items.first[i + 1] - items.first[i])
            b, n = place[start:end] - items.first[i], length[start:end]
            # No tile reaches beyond the common runs, so what they cover bounds the result.
            cover = np.bincount(b, minlength=size + 1) - np.bincount(b + n, minlength=size + 1)
            if (np.cumsum(cover[:size]) > 0).sum() < threshold * size:
                continue
            own = words.hashes[words.first[t] : words.first[t + 1]]
            marked = tiles(own, items.hashes[items.first[i] : items.first[i + 1]], at[start:end] - words.first[t], b, n)
            covered = sum(n for _, _, n in marked)
            if covered >= threshold * size:
                found.append((t, i, covered, size, len(marked)))
    return found


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``most`` characters; one longer item is a block of its own."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / most))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else items
        yield sorted(((r.id, r.text) for r in rows.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


@lru_cache(maxsize=1)
def _index(shared) -> Items:
    return Items(shared.value)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs of a document and a test item whose tokens it covers by at least ``threshold``.

    Tokens are runs of letters and digits, lower-cased. Returns ``doc_id``, ``item_id``,
    ``n_matched`` (item tokens under tiles), ``n_tokens``, ``n_tiles`` (long), ``coverage``.
    Items and documents with fewer than five tokens match nothing, like null and empty
    texts. Repeated rows on either side give repeated pairs. Extra columns are ignored,
    whatever their names. Empty tables give an empty result.
    """
    schema = "doc_id long, item_id long, n_matched long, n_tokens long, n_tiles long, coverage double"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for block in item_blocks(benchmark, item_col, item_text_col, most):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _index(shared)
            for batch in batches:
                ids = batch.column(0)
                for first, end, _, _ in K.blocks(batch.column(1)):
                    column = [t or "" for t in batch.column(1).slice(first, end - first).to_pylist()]
                    rows = leaks_of(column, items, threshold)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([first + r[0] for r in rows], pa.int64())),
                            pa.array([items.ids[r[1]] for r in rows], pa.int64()),
                            *[pa.array([r[k] for r in rows], pa.int64()) for k in (2, 3, 4)],
                            pa.array([r[2] / r[3] for r in rows], pa.float64()),
                        ],
                        names=["doc_id", "item_id", "n_matched", "n_tokens", "n_tiles", "coverage"],
                    )

        part = texts.mapInArrow(match, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that cover no test item (see :func:`leaks`)."""
    at = docs.columns.index(text_col)
    for block in item_blocks(benchmark, item_col, item_text_col, most):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _index(shared)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, end, _, _ in K.blocks(batch.column(at)):
                    column = [t or "" for t in batch.column(at).slice(first, end - first).to_pylist()]
                    for row in leaks_of(column, items, threshold):
                        keep[first + row[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
