"""Exact repeated substrings, by sorting suffixes that compare through hashes.

Two places that begin the same string of ``length`` bytes see the same smallest hash among the
short grams in it, so places are dealt to buckets by that hash and only suffixes of one
bucket have to be compared. Neighbouring places mostly share a bucket: a run of them is one
segment of text.

1. Segments that occur more than once as a whole are found by their hash; they need no text.
2. The other segments of a bucket fetch their text. Their suffixes are sorted by mergesort; two
   suffixes are compared by a binary search for their common extension on prefix polynomial
   hashes. Neighbours in that order that share ``length`` bytes are repeats; their bytes are compared.
3. A bucket with very many different segments is not sorted in one task: its places are
   spread by the hash of their whole string and counted.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm import textkernels as K

GRAM = 32

# Different segments of one bucket that one task sorts.
MOST = 4096

# Bytes of segments whose suffixes are sorted together.
SORT_BYTES = 1_000_000

_random = np.random.Generator(np.random.PCG64(400))
_FACTORS = _random.integers(1, 2**63, 5, dtype=np.uint64) | np.uint64(1)
_SECOND = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_INVERSE = np.uint64(pow(int(K.BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        _powers[name] = K.powers(base, max(n, K.BLOCK_BYTES))
    return _powers[name]


class PrefixHashes:
    """Hashes of any substring in constant time, from prefix sums of a polynomial."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * _power("up", K.BASE, n)[:n], out=self.sums[1:])
        self.scale = _power("down", _INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.scale[starts]


def gram_codes(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on."""
    if len(codes) < GRAM:
        return codes[:0]
    width = 1
    for factor in _FACTORS:
        codes = codes[:-width] * factor + codes[width:]
        width *= 2
    return K.mix(codes)


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Each run of places that share a bucket.

    Bucket, first and last place, two hashes of its text, and whether the bucket's gram occurs twice
    in it, without which the segment cannot hold a string of ``length`` bytes twice.
    """
    codes = K.BYTE_CODES[data]
    grams = gram_codes(codes)
    bucket = K.sliding(np.minimum, grams, length - GRAM + 1)
    long = np.diff(offsets) >= length
    first, last = offsets[:-1][long], offsets[1:][long] - length
    inside = np.zeros(len(bucket) + 1, np.int32)
    inside[first] += 1
    np.subtract.at(inside, last + 1, 1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    new[first] = True
    end = np.ones(len(bucket), bool)
    end[:-1] = new[1:] | ~inside[1:]
    starts, stops = np.flatnonzero(inside & new), np.flatnonzero(inside & end)
    size = (stops - starts).astype(np.uint64)
    one = K.mix(PrefixHashes(codes).of(starts, stops + length) ^ size)
    two = K.mix(PrefixHashes(_SECOND[data]).of(starts, stops + length) ^ size)
    bucket = bucket[starts]
    values = np.unique(bucket)
    maybe = np.zeros(1 << 20, bool)
    maybe[values >> np.uint64(44)] = True
    at = np.flatnonzero(maybe[grams >> np.uint64(44)])
    rank = np.minimum(np.searchsorted(values, grams[at]), max(len(values) - 1, 0))
    hit = values[rank] == grams[at] if len(values) else np.zeros(len(at), bool)
    occurs = np.sort(rank[hit] * len(data) + at[hit])
    own = np.searchsorted(values, bucket) * len(data)
    times = np.searchsorted(occurs, own + stops + length - GRAM, side="right") - np.searchsorted(occurs, own + starts)
    return bucket, starts, stops, one, two, times > 1


class Suffixes:
    """Suffixes of a text, compared on their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.hashes = PrefixHashes(K.BYTE_CODES[data])
        # The first eight bytes of each suffix as a number that sorts like them.
        words = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        for width in (1, 2, 4):
            words = (words[:-width] << np.uint64(8 * width)) | words[width:]
        self.words = words

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search on the hashes."""
        sums, up, down = self.hashes.sums, self.hashes.scale[x], self.hashes.scale[y]
        left, right = sums[x], sums[y]

        def equal(n, at=slice(None)) -> np.ndarray:
            a = (sums[x[at] + n] - left[at]) * up[at]
            return a == (sums[y[at] + n] - right[at]) * down[at]

        low = np.full(len(x), self.length)
        open_ = np.flatnonzero(~equal(self.length))
        low[open_] = 0
        high = np.full(len(open_), self.length)
        base = np.zeros(len(open_), np.int64)
        while len(open_) and (high - base > 1).any():
            mid = (base + high) >> 1
            same = equal(mid, open_)
            base = np.where(same, mid, base)
            high = np.where(same, high, mid)
        low[open_] = base
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before y; equal ones count where ``or_equal``."""
        n = self.common(x, y)
        whole = n >= self.length
        at = np.where(whole, 0, n)
        return np.where(whole, or_equal, self.data[x + at] < self.data[y + at])

    def sort(self, places: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in suffix order within their group, and where a new block of equal starts begins.

        Blocks that share a group and their first eight bytes are merge-sorted, all
        blocks side by side: each merge finds every suffix's rank in the sibling run.
        """
        order = np.lexsort((self.words[places], group))
        places, group = places[order], group[order]
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (self.words[places[1:]] != self.words[places[:-1]])
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(places)))
        run = 1
        while run < sizes.max(initial=0):
            big = sizes > run
            start = np.repeat(begin[big], sizes[big])
            size = np.repeat(sizes[big], sizes[big])
            at = K.ragged(np.zeros(int(big.sum()), np.int64), sizes[big])
            own = at // run
            sibling = (own ^ 1) * run
            many = np.clip(size - sibling, 0, run)
            right = (own & 1) == 1
            x = places[start + at]
            low, high = np.zeros(len(at), np.int64), many.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                y = places[start[open_] + sibling[open_] + mid]
                # An element of the right run goes behind equal ones of the left run.
                before = self.less(y, x[open_], right[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            target = start + (own & ~1) * run + (at - own * run) + low
            places[target] = x
            run *= 2
        return places, new

    def repeated(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The places whose first ``length`` bytes also begin at another place of their group."""
        places, new = self.sort(places, group)
        near = np.flatnonzero(~new[1:])
        x, y = places[near], places[near + 1]
        same = self.common(x, y) >= self.length
        x, y = x[same], y[same]
        # Hashes may collide; bytes may not.
        checks = [*range(0, self.length - 7, 8), self.length - 8]
        right = np.ones(len(x), bool)
        for step in checks:
            right &= self.words[x + step] == self.words[y + step]
        return np.unique(np.concatenate([x[right], y[right]]))


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    if not len(marked):
        return marked, marked
    cut = np.flatnonzero(np.diff(marked) != 1)
    return marked[np.concatenate([[0], cut + 1])], marked[np.append(cut, len(marked) - 1)]


def _find_segments(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(2)):
                if len(data) < length:
                    continue
                bucket, start, stop, one, two, own = segments(data, offsets, length)
                text = np.searchsorted(offsets, start, side="right") - 1
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(start - offsets[text]),
                        pa.array(stop - offsets[text]),
                        *[pa.array(v.view(np.int64)) for v in (bucket, one, two)],
                        pa.array(own),
                    ],
                    names=["v1", "v2", "p0", "p1", "m", "c1", "c2", "own"],
                )

    return find


def _fetch_segments(length: int):
    """The text of wanted segments; copies of a text in one task are read once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for v1, v2, text, wanted in zip(*[batch.column(i) for i in range(4)]):
                key = (v1.as_py(), v2.as_py())
                if key in seen:
                    continue
                seen.add(key)
                data = text.as_py().encode()
                for w in wanted.as_py():
                    out.append((w["m"], w["c1"], w["c2"], *key, w["p0"], w["alone"], w["hot"], data[w["p0"] : w["p1"] + length]))
                    size += len(out[-1][-1])
                if size > K.BLOCK_BYTES:
                    yield _segment_batch(out)
                    out, size = [], 0
            yield _segment_batch(out)

    return fetch


SEGMENT = "m long, c1 long, c2 long, v1 long, v2 long, p0 long, alone boolean, hot boolean, piece binary"


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 9
    names = [part.split()[0] for part in SEGMENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _whole_buckets(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows that arrive ordered by their first column, in tables of whole buckets of about ``most`` bytes."""
    waiting: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy()
        if waiting and size >= most and bucket[0] != last:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
        last = bucket[-1]
        cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        rows = max(1, int(most * batch.num_rows / max(batch.nbytes, 1)))
        start = 0
        while True:
            next_ = np.searchsorted(cuts, start + rows)
            if next_ == len(cuts):
                break
            cut = int(cuts[next_])
            yield pa.Table.from_batches([*waiting, batch.slice(start, cut - start)])
            waiting, size, start = [], 0, cut
        waiting.append(batch.slice(start))
        size += waiting[-1].nbytes
    if waiting:
        yield pa.Table.from_batches(waiting)


def _sort_buckets(length: int):
    """Ranges of repeated bytes in the segments of each bucket; rows arrive ordered by bucket and hash."""

    def ranges(rows: pa.Table) -> pa.RecordBatch:
        keys = np.stack([rows.column(c).to_numpy() for c in ("m", "c1", "c2")], axis=1)
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        rows, group = rows.filter(pa.array(fresh)), keys[fresh, 0]
        data, offsets = K.column_bytes(rows.column("piece"))
        counts = np.diff(offsets) - length + 1
        places = K.ragged(offsets[:-1], counts)
        found = Suffixes(data, length).repeated(places, np.repeat(group, counts))
        # Places of different segments are never next to each other.
        first, last = _runs(found)
        segment = np.searchsorted(offsets, first, side="right") - 1
        wanted = rows.column("alone").to_numpy()[segment]
        first, last, segment = first[wanted], last[wanted], segment[wanted]
        shift = rows.column("p0").to_numpy()[segment] - offsets[segment]
        at = pa.array(segment)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("v1").combine_chunks().take(at),
                rows.column("v2").combine_chunks().take(at),
                pa.array(first + shift),
                pa.array(last + shift + length),
            ],
            names=["v1", "v2", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_buckets(batches, SORT_BYTES):
            yield ranges(rows)

    return run


def _place_hashes(length: int):
    """The hash of the string at each place of a segment."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(3), K.BLOCK_BYTES // 8):
                counts = np.diff(offsets) - length + 1
                places = K.ragged(offsets[:-1], counts)
                segment = np.repeat(np.arange(len(counts)), counts)
                rows = pa.array(segment + first)
                one, two = (K.mix(PrefixHashes(t[data]).of(places, places + length)) for t in (K.BYTE_CODES, _SECOND))
                p0 = batch.column(2).to_numpy()[first:end]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(places - offsets[segment] + p0[segment]),
                        batch.column(4).take(rows),
                    ],
                    names=["w1", "w2", "v1", "v2", "start", "alone"],
                )

    return hashes


def repeated_ranges(texts: DataFrame, length: int, most: int = MOST) -> DataFrame:
    """``v1``, ``v2``, ``start``, ``end``: byte ranges covered by strings that begin elsewhere too.

    ``texts(v1, v2, text)`` has a row per document, ``v1`` and ``v2`` being hashes of its text.
    """
    runs = as_table(
        texts.mapInArrow(
            _find_segments(length), "v1 long, v2 long, p0 long, p1 long, m long, c1 long, c2 long, own boolean"
        ),
        "runs",
    )
    met = runs.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own")).filter("n > 1 OR own")
    runs = as_table(runs.join(met.select("m"), "m"), "met-runs")
    content = ["m", "c1", "c2"]
    kinds = as_table(
        runs.groupBy(*content).agg(
            F.count(F.lit(1)).alias("n"),
            F.max("own").alias("own"),
            F.min(F.struct("v1", "v2", "p0", "p1")).alias("where"),
        ),
        "segments",
    )
    whole = runs.join(kinds.filter("n > 1").select(*content), content).select(
        "v1", "v2", F.col("p0").alias("start"), (F.col("p1") + length).alias("end")
    )
    # A bucket whose segments all are repeats has nothing more to find.
    crowd = (
        kinds.groupBy("m")
        .agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"), F.max(F.expr("own AND n = 1")).alias("own"))
        .filter("(kinds > 1 AND least = 1) OR own")
        .select("m", (F.col("kinds") > most).alias("hot"))
    )
    members = kinds.join(crowd, "m").select(*content, "where.*", (F.col("n") == 1).alias("alone"), "hot")
    wanted = members.groupBy("v1", "v2").agg(
        F.collect_list(F.struct("m", "c1", "c2", "p0", "p1", "alone", "hot")).alias("wanted")
    )
    pieces = texts.filter(F.octet_length("text") >= length).join(wanted, ["v1", "v2"])
    pieces = as_table(pieces.select("v1", "v2", "text", "wanted").mapInArrow(_fetch_segments(length), SEGMENT), "pieces")
    sorted_ = pieces.filter("NOT hot").repartition("m").sortWithinPartitions(*content)
    parts = sorted_.mapInArrow(_sort_buckets(length), "v1 long, v2 long, start long, end long")
    places = as_table(
        pieces.filter("hot").dropDuplicates(content).select("v1", "v2", "p0", "piece", "alone").mapInArrow(
            _place_hashes(length), "w1 long, w2 long, v1 long, v2 long, start long, alone boolean"
        ),
        "places",
    )
    twice = places.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    spread = places.filter("alone").join(twice, ["w1", "w2"]).select("v1", "v2", "start", (F.col("start") + length).alias("end"))
    return whole.unionByName(parts).unionByName(spread)


def _cut_ranges():
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept = [], [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                found = sorted((r["start"], r["end"]) for r in ranges.as_py() or ())
                runs: list[list[int]] = []
                for start, end in found:
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                upto, parts = 0, []
                for start, end in runs:
                    parts.append(data[upto:start])
                    upto = end
                rest = b"".join([*parts, data[upto:]])
                removed.append(len(data) - len(rest))
                spans.append([{"start": s, "end": e} for s, e in runs])
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return cut


def without_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", most: int = MOST
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also begins anywhere else.

    Texts are UTF-8 bytes; strings never cross documents, overlaps count, and strings are judged
    on the input. Returns per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (long),
    ``kept_sha256`` (of the remaining bytes, lowercase hex) and ``spans`` (removed byte
    ranges). A null text is empty. Rows with equal ids are documents of their own, so
    equal rows repeat each other. Extra columns are ignored, whatever their names. An
    empty table gives an empty result. ``length`` must be at least 64.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("v1"), F.xxhash64(F.lit(1), "text").alias("v2"), "text"
    )
    found = repeated_ranges(texts.select("v1", "v2", "text"), length, most)
    ranges = as_table(found, "ranges").groupBy("v1", "v2").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    return texts.join(ranges, ["v1", "v2"], "left").select("doc_id", "text", "ranges").mapInArrow(
        _cut_ranges(),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>",
    )
