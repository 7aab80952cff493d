"""Packing tokenised documents into training sequences.

A document is cut where it is tokenised: full sequences first, then a remainder in
pieces. Only piece descriptions travel from there on, never token ids. Remainders are dealt to groups
of about ``GROUP_WINDOWS`` sequences, and each group is divided by Karmarkar-Karp
multiway differencing: the two partial partitions with the largest spread are merged
so that their imbalances cancel, which gives near-equal windows. When the fullest
window exceeds the capacity, the group gets one window more.
"""

import heapq
import json
import math
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table

# Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

GROUP_WINDOWS = 96

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


@lru_cache(maxsize=4)
def encoder(path: str):
    """An encoder with the ids of the byte-level BPE vocabulary in a ``tokenizers`` JSON file.

    The ids in such a file are the merge ranks, so the faster engine can run them. Its added tokens are
    not part of it (see ``encode_added``).
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def added(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` JSON file and their ids, longest first."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    if odd := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that depend on what surrounds them: {odd}")
    return {t["content"]: t["id"] for t in sorted(tokens, key=lambda t: -len(t["content"]))}


def encode_added(path: str) -> Callable[[str], list[int]]:
    """Ids of a text as ``tokenizers`` gives them by default: added tokens first, each with its own id."""
    ordinary, ids = encoder(path).encode_ordinary, added(path)
    if not ids:
        return ordinary
    found = re.compile("(" + "|".join(map(re.escape, ids)) + ")")

    def encode(text: str) -> list[int]:
        if not found.search(text):
            return ordinary(text)
        out: list[int] = []
        for i, part in enumerate(found.split(text)):
            out += [ids[part]] if i % 2 else ordinary(part)
        return out

    return encode


def cuts(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full sequences, then pieces of the remainder."""
    full = tokens // capacity * capacity
    found = [(s, capacity) for s in range(0, full, capacity)]
    return found + [(s, min(piece, tokens - s)) for s in range(full, tokens, piece)]


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int, piece: int, end_id: int, added_tokens: bool = False
) -> DataFrame:
    """One row per piece: place in its document, length and checksum of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_added(vocabulary) if added_tokens else encoder(vocabulary).encode_ordinary
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array(encode(text.as_py() or "") + [end_id], dtype="<u4")
                for start, length in cuts(len(ids), capacity, piece):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(columns, (doc_id, start, length, crc, len(ids))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.mapInArrow(cut, PIECES)


def differencing(sizes: np.ndarray, ways: int) -> np.ndarray:
    """Karmarkar-Karp multiway differencing: the window of each size, for ``ways`` windows.

    A partial partition is ``ways`` sums in descending order with the tree node that
    holds each window's content. Nodes below ``len(sizes)`` are single pieces.
    """
    parent = list(range(len(sizes)))
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(ways, np.int64), np.full(ways, -1, np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-int(size) if ways > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        sums, others = sums + other[::-1], others[::-1]
        both = np.flatnonzero((nodes >= 0) & (others >= 0))
        merged = np.maximum(nodes, others)
        for w in both:
            node = len(parent)
            parent.append(node)
            parent[nodes[w]] = parent[others[w]] = node
            merged[w] = node
        order = np.argsort(-sums, kind="stable")
        sums, merged = sums[order], merged[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), serial, sums, merged))
        serial += 1
    window = np.full(len(parent), -1, np.int64)
    nodes = heap[0][3]
    window[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for node in range(len(parent) - 1, -1, -1):
        if window[node] < 0:
            window[node] = window[parent[node]]
    return window[: len(sizes)]


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; the window count rises until none exceeds the capacity."""
    ways = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        window = differencing(sizes, ways)
        if np.bincount(window, weights=sizes, minlength=ways).max() <= capacity:
            return window
        ways += 1


def _pack_group(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        length = group.column("length").to_numpy()
        order = np.lexsort((group.column("start").to_numpy(), group.column("doc_id").fill_null(-1).to_numpy()))
        window = np.empty(len(length), np.int64)
        window[order] = windows(length[order], capacity)
        placed = order[np.argsort(window[order], kind="stable")]
        sizes, at = length[placed], window[placed]
        before = np.cumsum(sizes) - sizes
        first = np.r_[True, at[1:] != at[:-1]]
        offset = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(at)]))
        part = group.column("part").to_numpy()[0]
        return (
            group.take(pa.array(placed))
            .drop_columns(["part"])
            .append_column("sequence_id", pa.array((np.int64(part) << 24) + at))
            .append_column("offset", pa.array(offset))
        )

    return pack


def packed(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    piece: int = 512,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``vocabulary`` is the path of a byte-level BPE file, readable on every executor. A
    document is the ids of its text and ``end_id``; a null or empty text is ``end_id``
    alone. With ``added_tokens`` the added tokens of the vocabulary have their own ids where a text holds
    them, as ``tokenizers`` does by default; without, they are ordinary text. Returns one row per piece: ``doc_id``, ``start`` (ids before it in its
    document), ``length``, ``ids_crc32`` (of its ids as little-endian 32-bit numbers),
    ``doc_tokens``, ``sequence_id`` and ``offset`` (place there, gapless from 0).

    Every row of ``docs`` is a document, also rows with equal or null ids. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = as_table(pieces(texts, vocabulary, capacity, piece, end_id, added_tokens), "pieces")
    left = cut.filter(F.col("length") < capacity)
    tokens = left.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(tokens / (capacity * GROUP_WINDOWS)))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    small = left.withColumn("part", part).groupBy("part").applyInArrow(_pack_group(capacity), PACKED)
    full = cut.filter(F.col("length") == capacity).select(
        "*",
        (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(small)
