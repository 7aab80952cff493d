"""Alignment of two tokenizers over the same texts.

Both token sequences of a text spell the same bytes. Byte offsets where tokens of both end cut them into
groups, and the two tokens that end there are linked. Offsets are found in lockstep: one state vector
holds the places of all documents of a block in both sequences, and each step advances in every document
the side that is behind, or both where they meet; finished documents are compacted away. A
long document takes several places of the vector, so the number of steps is bounded.

Links are counted over the corpus as id pairs. The most frequent pairs, of bounded number, are broadcast to
score the links of each document; the others are joined.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm.packing import encoder

# Characters of text that are aligned at once; a longer text is a block of its own.
BLOCK_CHARS = 300_000
# Tokens of the first side that one place of the state vector works off.
LANE = 96
# Links that are scored at once; a row with more is scored alone.
SCORED_LINKS = 100_000
# Pairs that are broadcast with their counts.
HEAD_PAIRS = 262_144


@dataclass(frozen=True)
class Side:
    """A tokenizer: ids of a text, and the bytes of each id."""

    encode: Callable[[str], list[int]]
    pieces: list[bytes]
    sizes: np.ndarray
    # Decimal digits of each id, padded with zero bytes.
    digits: np.ndarray

    @classmethod
    def of(cls, encode: Callable[[str], list[int]], pieces: list[bytes]) -> "Side":
        width = len(str(len(pieces)))
        digits = np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(len(pieces))), np.uint8)
        return cls(encode, pieces, np.array([len(p) for p in pieces], np.int64), digits.reshape(-1, width))

    def spells(self, ids: list[int], text: bytes) -> bool:
        """Whether the bytes of the tokens, none of them empty, are ``text``."""
        found = [self.pieces[i] for i in ids]
        return all(found) and b"".join(found) == text


@lru_cache(maxsize=2)
def byte_level(path: str) -> Side:
    """A byte-level BPE file of ``tokenizers``; strings of its special tokens are plain text."""
    known = encoder(path)
    pieces = [known.decode_single_token_bytes(i) for i in range(known.n_vocab)]
    return Side.of(lambda text: known.encode_ordinary(" " + text), pieces)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Side:
    """A ``sentencepiece`` model, which puts a space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def piece(i: int) -> bytes:
        text = model.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace("▁", " ").encode()

    return Side.of(model.encode, [piece(i) for i in range(model.vocab_size())])


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end where one of the other ends.

    ``a_ends`` and ``b_ends`` are ascending byte offsets over the texts of a block; ``a_first`` has the first token of
    each document and the end. Both sides end together at the end of each document.
    """
    cut_a, cut_b = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    lanes = -(-np.diff(a_first) // LANE)
    if not lanes.sum():
        return cut_a, cut_b
    before = np.cumsum(lanes) - lanes
    number = np.arange(int(lanes.sum())) - np.repeat(before, lanes)
    at_a = np.repeat(a_first[:-1], lanes) + number * LANE
    at_b = np.searchsorted(b_ends, np.r_[0, a_ends][at_a], side="right")
    state = np.stack([at_a, np.r_[at_a[1:], len(a_ends)], at_b, np.r_[at_b[1:], len(b_ends)]])
    state = state[:, (state[0] < state[1]) & (state[2] < state[3])]
    while state.shape[1]:
        at_a, stop_a, at_b, stop_b = state
        end_a, end_b = a_ends[at_a], b_ends[at_b]
        met = end_a == end_b
        cut_a[at_a[met]] = True
        cut_b[at_b[met]] = True
        at_a += end_a <= end_b
        at_b += end_b <= end_a
        going = (at_a < stop_a) & (at_b < stop_b)
        if not going.all():
            state = state[:, going]
    return cut_a, cut_b


@dataclass(frozen=True)
class Block:
    """Aligned documents: ids and cuts of all of them, and the bounds between documents."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray

    @classmethod
    def of(cls, a: Side, b: Side, texts: list[str | None]) -> "Block":
        none = np.zeros(0, np.int32)
        ids = [(none, none)]
        for text in texts:
            pair = (a.encode(text), b.encode(text)) if text else ([], [])
            spelled = (" " + text).encode() if text else b""
            same = a.spells(pair[0], spelled) and b.spells(pair[1], spelled)
            ids.append((np.array(pair[0], np.int32), np.array(pair[1], np.int32)) if same else ids[0])
        a_ids, b_ids = (np.concatenate([pair[side] for pair in ids]) for side in (0, 1))
        a_first, b_first = (np.cumsum([len(pair[side]) for pair in ids]) for side in (0, 1))
        cut_a, cut_b = lockstep(np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids]), a_first)
        return cls(a_ids, b_ids, cut_a, cut_b, a_first, b_first)

    def groups(self) -> np.ndarray:
        """Bounds between documents in the list of groups, which is also the list of links."""
        return np.r_[0, np.cumsum(self.cut_a)][self.a_first]

    def bounds(self, side: str) -> np.ndarray:
        """Tokens of a side up to the end of each group, counted in its document."""
        cut, first = (self.cut_a, self.a_first) if side == "a" else (self.cut_b, self.b_first)
        return np.flatnonzero(cut) + 1 - np.repeat(first[:-1], np.diff(self.groups()))

    def written(self, a: Side, b: Side) -> list[bytes]:
        """Groups of each document as ``a1,a2|b1;a3|b2``: the ids of both sides, rendered side by side."""
        ends_a, ends_b = (np.r_[0, np.flatnonzero(c) + 1] for c in (self.cut_a, self.cut_b))
        group_a, group_b = (np.cumsum(c) - c for c in (self.cut_a, self.cut_b))
        place_a = np.arange(len(self.a_ids)) + ends_b[group_a]
        place_b = np.arange(len(self.b_ids)) + ends_a[group_b + 1] if len(self.b_ids) else group_b
        width = max(a.digits.shape[1], b.digits.shape[1])
        shown = np.zeros((len(self.a_ids) + len(self.b_ids), width + 1), np.uint8)
        shown[place_a, : a.digits.shape[1]] = a.digits[self.a_ids]
        shown[place_b, : b.digits.shape[1]] = b.digits[self.b_ids]
        shown[place_a, width] = np.where(self.cut_a, ord("|"), ord(","))
        shown[place_b, width] = np.where(self.cut_b, ord(";"), ord(","))
        upto = np.r_[0, np.cumsum((shown != 0).sum(axis=1))][self.a_first + self.b_first]
        text = shown[shown != 0].tobytes()
        return [text[s : max(s, e - 1)] for s, e in zip(upto[:-1].tolist(), upto[1:].tolist())]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _blocks(batches: Iterator[pa.RecordBatch], a: Side, b: Side) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Aligned runs of rows of about ``BLOCK_CHARS``."""
    for batch in batches:
        first, size, texts = 0, 0, []
        for at, value in enumerate(batch.column(0)):
            texts.append(value.as_py())
            size += len(texts[-1] or "")
            if size >= BLOCK_CHARS or at + 1 == batch.num_rows:
                yield batch.slice(first, at + 1 - first), Block.of(a, b, texts)
                first, size, texts = at + 1, 0, []


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens and groups of every document.

    Returns ``doc_id``, ``a_ids`` and ``b_ids`` (ids of both sides), ``a_bounds`` and ``b_bounds`` (tokens up to
    the end of each group). The last tokens of a group end together and are linked. See :func:`scored`.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), sentence_pieces(b_path)
        for rows, block in _blocks(batches, a, b):
            groups = block.groups()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(1), _lists(block.a_ids, block.a_first), _lists(block.b_ids, block.b_first),
                    _lists(block.bounds("a"), groups), _lists(block.bounds("b"), groups),
                ],
                names=["doc_id", "a_ids", "b_ids", "a_bounds", "b_bounds"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(
        align, "doc_id long, a_ids array<int>, b_ids array<int>, a_bounds array<int>, b_bounds array<int>"
    )


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Numbers of tokens, groups and links, the hash of the groups, and the links as ``link_a`` and ``link_b``."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), sentence_pieces(b_path)
        for rows, block in _blocks(batches, a, b):
            groups = block.groups()
            numbers = [pa.array(np.diff(x)) for x in (block.a_first, block.b_first, groups, groups)]
            hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in block.written(a, b)]
            links = [_lists(block.a_ids[block.cut_a], groups), _lists(block.b_ids[block.cut_b], groups)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), *numbers, pa.array(hashes, pa.string()), *links],
                names=["doc_id", *COUNTS, "groups_sha256", "link_a", "link_b"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(align, DIGEST + ", link_a array<int>, link_b array<int>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` (links of the pair in all documents) and ``best`` (no other pair of that ``b`` has more)."""
    pairs = links.select(F.explode(F.arrays_zip("link_a", "link_b")).alias("l")).select(
        F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b")
    )
    counts = as_table(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    # At most one row per id of the first side in a window.
    highest = F.max("n").over(Window.partitionBy("b"))
    return as_table(counts.withColumn("best", F.col("n") == highest), "pairs")


def _codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


SCORED = DIGEST + ", row long, n_best long, count_sum long, rest array<struct<a:int,b:int,times:long>>"


def _few_links(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``SCORED_LINKS`` links."""
    ends, first = np.asarray(batch.column("link_a").offsets)[1:], 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else ends[0]
        end = max(int(np.searchsorted(ends, before + SCORED_LINKS, side="right")), first + 1)
        yield batch.slice(first, end - first)
        first = end


def _with_head(links: DataFrame, head: list) -> DataFrame:
    """Sums over the links whose pair is in ``head``, and the other pairs of each document with their number."""
    codes = _codes(np.array([r["a"] for r in head], np.int64), np.array([r["b"] for r in head], np.int64))
    order = np.argsort(codes)
    counts = np.array([r["n"] for r in head], np.int64)[order]
    best = np.array([r["best"] for r in head], np.int64)[order]
    shared = links.sparkSession.sparkContext.broadcast((codes[order], counts, best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in (part for whole in batches for part in _few_links(whole)):
            a, b = batch.column("link_a"), batch.column("link_b")
            bounds = np.asarray(a.offsets).astype(np.int64) - a.offsets[0].as_py()
            code = _codes(np.asarray(a.flatten()), np.asarray(b.flatten()))
            at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            found = known[at] == code if len(known) else np.zeros(len(code), bool)

            def per_row(values: np.ndarray) -> np.ndarray:
                return np.diff(np.r_[0, np.cumsum(values)][bounds])

            sums = [per_row(np.where(found, x[at], 0) if len(x) else np.zeros(len(code), np.int64)) for x in (best, counts)]
            # Links outside the head, counted per row and pair.
            left = np.flatnonzero(~found)
            row = np.searchsorted(bounds, left, side="right") - 1
            order = np.lexsort((code[left], row))
            row, pair = row[order], code[left][order]
            new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])][: len(row)])
            times = np.diff(np.r_[new, len(row)])
            rest_bounds = np.searchsorted(row[new], np.arange(batch.num_rows + 1)).astype(np.int32)
            rest = pa.StructArray.from_arrays(
                [pa.array((pair[new] >> 32).astype(np.int32)), pa.array((pair[new] & 0xFFFFFFFF).astype(np.int32)),
                 pa.array(times.astype(np.int64))], names=["a", "b", "times"],
            )
            kept = [batch.column(n) for n in ("doc_id", *COUNTS, "groups_sha256", "row")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(pa.array(rest_bounds), rest)],
                names=["doc_id", *COUNTS, "groups_sha256", "row", "n_best", "count_sum", "rest"],
            )

    return links.mapInArrow(score, SCORED)


def scored(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How well the two tokenizers agree in every document.

    Returns ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best`` (links whose pair is, of the
    pairs with its second id, the most frequent one of the corpus, ties included) and ``count_sum`` (over
    the links, how many links of the corpus have their pair).

    A text that is null or empty, or whose tokens do not spell a space and the text, has no tokens: zeros and
    an empty hash. Rows with equal or null ids are documents of their own. Columns other than id and text are ignored,
    whatever their names. An empty table gives an empty result. Both files must be readable on every executor;
    memory of a task grows with its longest text.
    """
    found = linked(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    links = as_table(found, "links")
    pairs = pair_counts(links)
    head = pairs.orderBy(F.desc("n"), "a", "b").limit(HEAD_PAIRS).collect()
    near = as_table(_with_head(links, head), "scored-links")
    columns = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    if len(head) < HEAD_PAIRS:
        # All pairs were broadcast.
        return near.select(*columns)
    # Pairs outside the head are rare, so none of them fills a task.
    rest = near.select("row", F.explode("rest").alias("r")).select("row", "r.a", "r.b", "r.times").join(pairs, ["a", "b"])
    sums = as_table(
        rest.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_count"),
        ),
        "rare-links",
    )
    more = lambda c, m: (F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c)
    joined = near.join(sums, "row", "left").select(
        "doc_id", *COUNTS, more("n_best", "more_best"), more("count_sum", "more_count"), "groups_sha256"
    )
    return joined.select(*columns)
