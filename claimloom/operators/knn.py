"""Exact k-nearest-neighbour join, vote and grid over k.

A k-d tree over a bounded sample of base rows (Bentley, 1975) cuts space into parts of at most ``PART_BYTES``. Base rows
and query rows travel as packed pieces of their part. A query is first answered within its own part; the distance of
its k-th neighbour there bounds which other parts it visits, by their boxes. In a part both sides are cut again into
leaves, leaves too far away are left out, and what is left is compared by matrix products of bounded size.

Where boxes leave nothing out, as among many independent coordinates, all pairs are compared: a base row is sent once to
each share of the queries and a query once to each part, so what is shuffled grows with the rows times the parts
and never with the pairs.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimloom.functions.ranks import hash_of, number_copies
from claimloom.functions.skew import lookup_join
from claimloom.functions.storage import as_table, cut, drop_table, next_table, spread, tasks_for
from claimloom.operators.encoders import TableModel

# The parts' boxes are held by the driver and all tasks.
MAX_PARTS = 1024
# Bytes of a part's vectors, which one task holds, and rows below which a part is not worth a task.
PART_BYTES, LEAST_ROWS = 64_000_000, 2048
SAMPLE_ROWS = 64
# Up to so many coordinates boxes leave out most parts, so there are as many parts as tasks.
NARROW = 16
# Rows of a leaf, and rows that are compared at once.
RING_ROWS = 256
BLOCK_ROWS = 4096
PIECE_ROWS = 512
# Distances are compared after rounding, so equal distances tie by id.
DIGITS = 9
SLACK = 1e-9


def _nearest_rows(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` rows of ``b`` nearest to each row of ``a``: row, row of ``b`` and rounded distance; ties to the first."""
    return _search(a, b, np.arange(len(b)), k, np.full(len(a), np.inf))[:3]


def _split(points: np.ndarray) -> tuple[int, float] | None:
    """The coordinate that varies most and where to cut it: rows up to there are at most half if values differ enough."""
    if len(points) < 2:
        return None
    axis = int(points.var(axis=0).argmax())
    values = points[:, axis]
    top = values.max()
    at = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
    if at == top:
        below = values[values < top]
        if not len(below):
            return None
        at = below.max()
    return axis, float(at)


def _leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in leaves of at most ``size`` rows, near ones after each other."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        found = _split(points[rows]) if len(rows) > size else None
        if found is None:
            out += [rows[i : i + size] for i in range(0, len(rows), size)]
            continue
        right = points[rows, found[0]] > found[1]
        stack += [rows[right], rows[~right]]
    return out


def _apart(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance of each row to each box."""
    out = np.zeros((len(x), len(low)))
    for i in range(x.shape[1]):
        gap = np.maximum(low[:, i] - x[:, i, None], x[:, i, None] - high[:, i])
        out += np.maximum(gap, 0, out=gap) ** 2
    return np.sqrt(out)


def _farthest(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distance of each row to the farthest point of each box."""
    out = np.zeros((len(x), len(low)))
    for i in range(x.shape[1]):
        out += np.maximum(np.abs(low[:, i] - x[:, i, None]), np.abs(high[:, i] - x[:, i, None])) ** 2
    return np.sqrt(out)


def _better(
    a: np.ndarray, b: np.ndarray, k: int, limit: np.ndarray, keys: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, row of ``b`` and rounded distance of all pairs that can be among the ``k`` nearest and within ``limit``.

    A matrix product finds them, with a margin for its rounding; only their distances are computed as such. With
    ``keys`` (rows x tables) only pairs that share one count.
    """
    middle = (a.min(axis=0) + a.max(axis=0)) / 2
    if not np.isfinite(middle).all():
        middle = np.zeros(a.shape[1])
    x, y = a - middle, b - middle
    norms = (x**2).sum(axis=1), (y**2).sum(axis=1)
    squares = norms[0][:, None] + norms[1] - 2 * (x @ y.T)
    if np.isfinite(squares).all():
        margin = 1e-12 * (norms[0] + norms[1].max(initial=0))
        last, unbounded = limit, np.isinf(limit).any()
        if keys is not None and unbounded:
            shared = np.zeros(squares.shape, bool)
            for t in range(keys[0].shape[1]):
                shared |= keys[0][:, t, None] == keys[1][:, t]
            squares[~shared] = np.nan
            nearest = np.partition(np.where(shared, squares, np.inf), k - 1, axis=1)[:, k - 1] if len(b) >= k else np.full(len(a), np.inf)
            last = np.minimum(limit, np.sqrt(np.maximum(nearest + margin, 0)))
        elif len(b) > k and unbounded:
            nearest = np.maximum(np.partition(squares, k - 1, axis=1)[:, k - 1] + margin, 0)
            last = np.minimum(limit, np.sqrt(nearest))
        # Distances that round alike tie.
        reach = (last + 2 * 10.0**-DIGITS) ** 2 + margin
        row, place = np.divmod(np.flatnonzero(squares <= reach[:, None]), max(1, len(b)))
    else:
        row, place = (v.ravel() for v in np.indices(squares.shape))
    if keys is not None:
        kept = (keys[0][row] == keys[1][place]).any(axis=1)
        row, place = row[kept], place[kept]
    gaps = _gaps(a, b, row, place)
    kept = ~(gaps > limit[row] + SLACK)
    return row[kept], place[kept], gaps[kept]


def _gaps(a: np.ndarray, b: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rounded distances of pairs."""
    gaps = np.empty(len(row))
    step = max(1, 4_000_000 // max(1, b.shape[1]))
    for i in range(0, len(row), step):
        gap = a[row[i : i + step]] - b[place[i : i + step]]
        gaps[i : i + step] = np.sqrt(np.einsum("nd,nd->n", gap, gap))
    return np.round(gaps, DIGITS)


def _first_of(row: np.ndarray, place: np.ndarray, gaps: np.ndarray, order_of: np.ndarray, k: int) -> tuple:
    """The ``k`` nearest of each row; ties by ``order_of``."""
    order = np.lexsort((order_of[place], gaps, row))
    row, place, gaps = row[order], place[order], gaps[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], place[kept], gaps[kept]


def _search(
    a: np.ndarray, b: np.ndarray, order_of: np.ndarray, k: int, reach: np.ndarray, keys: tuple | None = None
) -> tuple:
    """The ``k`` rows of ``b`` nearest to each row of ``a`` that are within ``reach``: row, row of ``b``, rounded
    distance, and the number of pairs compared. Ties go to the lower ``order_of``. With
    ``keys`` of both sides only pairs that share one count."""
    if not len(a) or not len(b):
        return np.empty(0, int), np.empty(0, int), np.empty(0), 0
    leaves = _leaves(b, RING_ROWS if b.shape[1] <= NARROW else BLOCK_ROWS)
    low, high = (np.array([f(b[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    sizes = np.array([len(rows) for rows in leaves])
    found, compared = [], 0
    # Few queries among many rows lie far apart, and a leaf of them would visit what lies between.
    size = 256 if b.shape[1] > NARROW else min(256, max(8, RING_ROWS * len(a) // len(b)))
    for rows in _leaves(a, min(BLOCK_ROWS, size)):
        x = a[rows]
        limit = reach[rows] + 2 * SLACK
        best = (np.empty(0, int), np.empty(0, int), np.empty(0))
        least = np.sqrt((np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0) ** 2).sum(axis=1))
        order = np.argsort(least, kind="stable")
        # The nearest leaves that hold k rows give a first bound.
        start = int(np.searchsorted(np.cumsum(sizes[order]), k)) + 1 if np.isinf(limit).any() else 0
        groups, at = [order[:start]] if start else [], start
        while groups or at < len(order):
            if groups:
                group = groups.pop()
            else:
                group = order[at : at + max(1, 64 * BLOCK_ROWS // RING_ROWS)]
                at += len(group)
                group = group[least[group] <= limit.max()]
                if not len(group):
                    break
                group = group[(_apart(x, low[group], high[group]) <= limit[:, None]).any(axis=0)]
                ends = np.cumsum(sizes[group])
                groups = [group[(ends - 1) // BLOCK_ROWS == i] for i in range(int((ends[-1] - 1) // BLOCK_ROWS), -1, -1)] if len(group) else []
                groups = [g for g in groups if len(g)]
                continue
            group = group[least[group] <= limit.max()]
            if not len(group):
                continue
            base = np.concatenate([leaves[i] for i in group])
            compared += len(x) * len(base)
            row, place, gaps = _better(x, b[base], k, limit, keys and (keys[0][rows], keys[1][base]))
            best = _first_of(*(np.concatenate(v) for v in zip(best, (row, base[place], gaps))), order_of, k)
            # Only rows with k neighbours are bounded.
            last = np.flatnonzero(np.bincount(best[0], minlength=len(x)) == k)
            limit[last] = np.minimum(limit[last], best[2][np.searchsorted(best[0], last, "right") - 1] + 2 * SLACK)
        found.append((rows[best[0]], *best[1:]))
    row, place, gaps = (np.concatenate(v) for v in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], place[order], gaps[order], compared


@dataclass
class Cells:
    """A k-d tree whose leaves are the parts. Right children follow the left ones; ``axis`` is -1 in leaves."""

    axis: np.ndarray
    at: np.ndarray
    left: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, parts: int) -> "Cells":
        """Up to ``parts`` parts; each holds some of the points."""
        axis, at, left, whole = [-1], [0.0], [-1], {0: points}
        leaves = 1
        while whole and leaves < parts:
            node = max(whole, key=lambda n: len(whole[n]))
            inside = whole.pop(node)
            found = _split(inside)
            if found is None:
                continue
            right = inside[:, found[0]] > found[1]
            axis[node], at[node], left[node] = *found, len(axis)
            for side in (inside[~right], inside[right]):
                whole[len(axis)] = side
                axis.append(-1)
                at.append(0.0)
                left.append(-1)
            leaves += 1
        axis = np.array(axis)
        return cls(axis, np.array(at), np.array(left), np.where(axis < 0, np.cumsum(axis < 0) - 1, -1))

    @property
    def parts(self) -> int:
        return int((self.axis < 0).sum())

    def parts_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        moving = np.flatnonzero(self.axis[at] >= 0)
        while len(moving):
            here = at[moving]
            at[moving] = self.left[here] + (x[moving, self.axis[here]] > self.at[here])
            moving = moving[self.axis[at[moving]] >= 0]
        return self.number[at]


def _bytes(x: np.ndarray) -> bytes:
    """Numbers in four bytes each if that loses nothing."""
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    return (small if np.array_equal(small, x) else np.ascontiguousarray(x)).tobytes()


def _numbers(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * rows * width else float
    return np.frombuffer(data, kind).reshape(rows, width).astype(float)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow column of lists."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _lists(column: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), column)


def _joined(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.flatten() if len(table) else column


def _vectors(table: pa.Table, width: int) -> np.ndarray:
    counts = pc.list_value_length(table.column("ids")).to_pylist()
    pieces = [_numbers(v, n, width) for v, n in zip(table.column("vecs").to_pylist(), counts)]
    return np.concatenate(pieces) if pieces else np.empty((0, width))


def _type(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def _empty(kinds: str) -> pa.Table:
    return to_arrow_schema(StructType.fromDDL(kinds)).empty_table()


def _pieces(rows: DataFrame, cells: Cells, width: int, extra: list[str], keys: int = 0) -> DataFrame:
    """Rows packed by part: ids, vectors, ``keys`` numbers each and the box of at most ``PIECE_ROWS`` rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vec"), width)
            part = cells.parts_of(x)
            order = np.argsort(part, kind="stable")
            x, part = x[order], part[order]
            new = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            starts = np.concatenate([np.arange(a, b, PIECE_ROWS) for a, b in zip(new, np.r_[new[1:], len(x)])])
            ends = np.r_[starts[1:], len(x)]
            lists = [_lists(batch.column(c).take(pa.array(order)), np.r_[starts, len(x)]) for c in ("id", *extra)]
            packed = [[f(x[a:b]) for a, b in zip(starts, ends)] for f in (
                _bytes, lambda v: v.min(axis=0).tobytes(), lambda v: v.max(axis=0).tobytes())]
            found = batch.column("keys").flatten().to_numpy().reshape(-1, keys)[order] if keys else np.empty((len(x), 0), np.int64)
            packed.append([np.ascontiguousarray(found[a:b]).tobytes() for a, b in zip(starts, ends)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts], pa.int32()), *lists, *(pa.array(v, pa.binary()) for v in packed)],
                names=["part", "ids", *extra, "vecs", "low", "high", "keys"],
            )

    carried = "".join(f", `{c}` array<{_type(rows, c)}>" for c in extra)
    return rows.select("id", "vec", *extra, *(["keys"] if keys else [])).mapInArrow(
        pack, f"part int, ids array<{_type(rows, 'id')}>{carried}, vecs binary, low binary, high binary, keys binary"
    )


def _boxes(pieces: DataFrame, parts: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest and highest coordinates and rows of each part."""

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for part, low, high in zip(*(batch.column(c).to_pylist() for c in ("part", "low", "high"))):
                low, high = np.frombuffer(low), np.frombuffer(high)
                if part in known:
                    low, high = np.minimum(known[part][0], low), np.maximum(known[part][1], high)
                known[part] = low, high
        if known:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(known), pa.int32()), *(pa.array([v[i].tobytes() for v in known.values()], pa.binary()) for i in (0, 1))],
                names=["part", "low", "high"],
            )

    def merged(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(box(iter(group.to_batches()))))

    low, high = np.full((parts, width), np.inf), np.full((parts, width), -np.inf)
    kinds = "part int, low binary, high binary"
    # One row per part.
    for r in pieces.select("part", "low", "high").mapInArrow(box, kinds).groupBy("part").applyInArrow(merged, kinds).collect():
        low[r["part"]], high[r["part"]] = np.frombuffer(r["low"]), np.frombuffer(r["high"])
    rows = np.zeros(parts, int)
    for r in pieces.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect():
        rows[r["part"]] = r["n"]
    return low, high, rows


def _shares(asked: np.ndarray, held: np.ndarray, tasks: int, width: int) -> np.ndarray:
    """Into how many tasks each part's queries are dealt: by bytes, and by pairs so that all cores have work."""
    most = max(1, PART_BYTES // (8 * width + 64))
    pairs = asked.astype(float) * held
    even = np.ceil(pairs / max(1.0, pairs.sum() / tasks))
    shares = np.maximum(np.ceil(asked / most), np.minimum(even, np.ceil(asked / PIECE_ROWS)))
    return np.where(asked > 0, np.maximum(shares, 1), 0).astype(int)


def _meet(left: DataFrame, right: DataFrame, shares: np.ndarray, compare, kinds: str) -> DataFrame:
    """Pieces of queries with all base rows of their part, by tasks of a share of the part's queries."""
    of = F.array(*[F.lit(int(n)) for n in shares])[F.col("part")]
    left = left.withColumn("share", F.pmod(F.xxhash64("vecs"), of).cast("int"))
    right = right.filter(of > 0).withColumn("share", F.explode(F.sequence(F.lit(0), of - 1)))
    # Empty tasks cost little, and two groups seldom share one of so many.
    tasks = 3 * max(1, int(shares.sum()))
    keys = ["part", "share"]
    return (
        left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(compare, kinds)
    )


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    seed: int = 42,
    exclude_self: bool = False,
    carry: str | None = None,
    report: dict | None = None,
    keys: int = 0,
) -> DataFrame:
    """The ``k`` nearest base rows of every query row, exactly.

    Both tables have an ``id`` and a ``vec`` (array of doubles). Returns ``id``,
    ``neighbour``, ``distance`` (rounded) and ``rank``; ties go to the lower id.
    ``exclude_self`` leaves out the base row with the query's own id. ``carry`` names
    a base column to bring along, such as the label: a join on popular neighbours
    afterwards would be skewed. ``report`` gets the numbers of pairs ``compared`` and of ``all`` pairs of a
    query and a kept base row. With ``keys`` both tables have an array ``keys`` of so many numbers, and only rows that
    agree in one at the same place can be neighbours.
    """
    wanted = k + 1 if exclude_self else k
    extra, with_keys = [carry] if carry else [], ["keys"] if keys else []
    spark = queries.sparkSession
    base_kinds = "".join(f", `{c}` {_type(base, c)}" for c in extra)
    pair_kinds = f"id {_type(queries, 'id')}, neighbour {_type(base, 'id')}, distance double{base_kinds}"
    facts = base.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("width")).first()
    width = facts["width"] or 0
    if width < 1:
        return spark.createDataFrame([], f"{pair_kinds}, rank int")
    cells, tasks = _cells(base, facts["rows"], width, seed)
    held, held_at = next_table(_pieces(_few_copies(base, wanted, extra + with_keys), cells, width, extra, keys), "base")
    low, high, rows = _boxes(held, cells.parts, width)
    asked, asked_at = next_table(_pieces(spread(queries.select("id", "vec", *with_keys)), cells, width, [], keys), "asked")
    counts = np.zeros(cells.parts, int)
    for r in asked.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect():
        counts[r["part"]] = r["n"]

    def opened(left: pa.Table, right: pa.Table) -> tuple:
        ids = _joined(right, "ids")
        order_of = np.empty(len(ids), int)
        order_of[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        both = tuple(np.concatenate([np.frombuffer(v, np.int64) for v in t.column("keys").to_pylist()]).reshape(-1, keys) for t in (left, right)) if keys else None
        return _joined(left, "ids"), ids, _vectors(left, width), _vectors(right, width), order_of, both

    def pairs_of(q_ids, b_ids, right, row, place, gaps, starts) -> list:
        """Lists of ids, neighbours, distances and what is carried."""
        columns = [q_ids.take(pa.array(row)), b_ids.take(pa.array(place)), pa.array(gaps, pa.float64())]
        columns += [_joined(right, c).take(pa.array(place)) for c in extra]
        return [_lists(c, starts) for c in columns]

    names = ["found", "neighbours", "distances", *extra]
    lists = f"found array<{_type(queries, 'id')}>, neighbours array<{_type(base, 'id')}>, distances array<double>" + "".join(
        f", `{c}` array<{_type(base, c)}>" for c in extra
    )
    first_kinds = f"ids array<{_type(queries, 'id')}>, vecs binary, keys binary, reach binary, visits binary, {lists}, compared long"
    nothing = _empty(first_kinds), _empty(f"{lists}, compared long")

    def within(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours in the query's own part, and which other parts can hold nearer ones."""
        if not len(left) or not len(right):
            # A part without queries; all parts hold base rows.
            return nothing[0]
        q_ids, b_ids, q, b, order_of, both = opened(left, right)
        row, place, gaps, compared = _search(q, b, order_of, wanted, np.full(len(q), np.inf), both)
        own = left.column("part")[0].as_py()
        reach = np.full(len(q), np.inf)
        count = np.bincount(row, minlength=len(q))
        full = np.flatnonzero(count == wanted)
        reach[full] = gaps[np.searchsorted(row, full, "right") - 1]
        out = []
        for start in range(0, len(q), PIECE_ROWS):
            some = slice(start, start + PIECE_ROWS)
            x, open_ = q[some], np.isinf(reach[some])
            if open_.any() and not keys:
                reach[some][open_] = _bound(x[open_], low, high, rows, wanted)
            visits = _apart(x, low, high) <= reach[some][:, None] + 2 * SLACK
            visits[:, own] = False
            a, z = np.searchsorted(row, [start, start + len(x)])
            taken = pairs_of(q_ids, b_ids, right, row[a:z], place[a:z], gaps[a:z], [0, z - a])
            packed = [_bytes(x), both[0][some].tobytes() if keys else b"", reach[some].tobytes(), np.packbits(visits, axis=1).tobytes()]
            out.append(pa.RecordBatch.from_arrays(
                [_lists(q_ids[start : start + len(x)], [0, len(x)]), *(pa.array([v], pa.binary()) for v in packed), *taken,
                 pa.array([compared if not start else 0], pa.int64())],
                names=["ids", "vecs", "keys", "reach", "visits", *names, "compared"],
            ))
        return pa.Table.from_batches(out)

    first, first_at = next_table(_meet(asked, held, _shares(counts, rows, tasks, width), within, first_kinds), "first", asked_at)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A piece for each part that its queries still visit."""
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                n = len(ids)
                visits = np.unpackbits(np.frombuffer(batch.column("visits")[i].as_py(), np.uint8).reshape(n, -1), axis=1)[:, : cells.parts]
                going = np.flatnonzero(visits.any(axis=0))
                if not len(going):
                    continue
                x, reach = _numbers(batch.column("vecs")[i].as_py(), n, width), np.frombuffer(batch.column("reach")[i].as_py())
                found = np.frombuffer(batch.column("keys")[i].as_py(), np.int64).reshape(n, -1)
                who = [np.flatnonzero(visits[:, p]) for p in going]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(going, pa.int32()), _lists(ids.take(pa.array(np.concatenate(who))), np.cumsum([0, *map(len, who)])),
                     *(pa.array([f(w) for w in who], pa.binary()) for f in (
                         lambda w: _bytes(x[w]), lambda w: found[w].tobytes(), lambda w: reach[w].tobytes()))],
                    names=["part", "ids", "vecs", "keys", "reach"],
                )

    def beyond(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours in another part that are as near as the last one known."""
        if not len(left) or not len(right):
            return nothing[1]
        q_ids, b_ids, q, b, order_of, both = opened(left, right)
        reach = np.concatenate([np.frombuffer(v) for v in left.column("reach").to_pylist()])
        row, place, gaps, compared = _search(q, b, order_of, wanted, reach, both)
        starts = np.unique(np.r_[0, np.searchsorted(row, np.arange(0, len(q), PIECE_ROWS)), len(row)])
        if len(starts) < 2:
            starts = np.array([0, 0])
        columns = pairs_of(q_ids, b_ids, right, row, place, gaps, starts)
        done = np.r_[compared, np.zeros(len(starts) - 2, int)]
        return pa.Table.from_arrays([*columns, pa.array(done, pa.int64())], names=[*names, "compared"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells.parts, int)
        for batch in batches:
            for ids, visits in zip(pc.list_value_length(batch.column("ids")).to_pylist(), batch.column("visits").to_pylist()):
                total += np.unpackbits(np.frombuffer(visits, np.uint8).reshape(ids, -1), axis=1)[:, : cells.parts].sum(axis=0, dtype=int)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["part", "n"])

    visitors = np.zeros(cells.parts, int)
    for r in first.select("ids", "visits").mapInArrow(count, "part int, n long").groupBy("part").agg(F.sum("n").alias("n")).collect():
        visitors[r["part"]] = r["n"]
    flat = lambda t: t.select(
        F.inline(F.arrays_zip(*[F.col(n).alias(n) for n in names]))
    ).toDF("id", "neighbour", "distance", *extra)
    results, compared = [first], first.agg(F.sum("compared")).first()[0] or 0
    if visitors.any():
        pieces = first.select("ids", "vecs", "keys", "reach", "visits").mapInArrow(
            sent, f"part int, ids array<{_type(queries, 'id')}>, vecs binary, keys binary, reach binary"
        )
        more, more_at = next_table(_meet(pieces, held, _shares(visitors, rows, tasks, width), beyond, f"{lists}, compared long"), "more")
        compared += more.agg(F.sum("compared")).first()[0] or 0
        results.append(more)
    if report is not None:
        report.update(compared=float(compared), all=float(rows.sum()) * float(counts.sum()))
    candidates = flat(results[0]) if len(results) == 1 else flat(results[0]).unionByName(flat(results[1]))
    if exclude_self:
        candidates = candidates.filter(F.col("id") != F.col("neighbour"))
    best = as_table(_best_of(candidates, k), "neighbours")
    for path in (held_at, first_at, *([more_at] if visitors.any() else [])):
        drop_table(spark, path)
    return best


def _cells(base: DataFrame, rows: int, width: int, seed: int) -> tuple[Cells, int]:
    """The parts, and how many tasks should share the work."""
    tasks = tasks_for(base.sparkSession) * 3
    # Among many coordinates each query visits most parts: then parts and shares of the queries are even.
    even = tasks if width <= NARROW else int(np.ceil(np.sqrt(tasks)))
    parts = min(MAX_PARTS, max(-(-rows * width * 8 // PART_BYTES), min(even, rows // LEAST_ROWS), 1))
    if parts == 1:
        return Cells.of(np.empty((0, width)), 1), tasks
    picked = (
        base.select("vec", hash_of(F.col("id").cast("string"), seed=seed).alias("h"))
        .orderBy("h").limit(SAMPLE_ROWS * parts).collect()
    )
    return Cells.of(np.unique(np.array([r.vec for r in picked], float), axis=0), parts), tasks


def _bound(x: np.ndarray, low: np.ndarray, high: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """A distance within which each row has ``k`` base rows: infinite if there are fewer."""
    some = np.flatnonzero(rows)
    far = _farthest(x, low[some], high[some])
    order = np.argsort(far, axis=1)
    enough = np.cumsum(rows[some][order], axis=1) >= k
    at = enough.argmax(axis=1)
    out = np.take_along_axis(np.take_along_axis(far, order, axis=1), at[:, None], axis=1)[:, 0] * (1 + SLACK) + SLACK
    return np.where(enough.any(axis=1), out, np.inf)


def _few_copies(base: DataFrame, wanted: int, extra: list[str]) -> DataFrame:
    """Of equal base vectors only the first few ids can ever be neighbours. The group limit is applied
    before the shuffle, so many copies cost little."""
    copies = Window.partitionBy("vec").orderBy("id")
    return (
        base.select("id", "vec", *extra)
        .withColumn("copy_no", F.row_number().over(copies))
        .filter(F.col("copy_no") <= wanted)
        .drop("copy_no")
    )


def _best_of(candidates: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("id").orderBy("distance", "neighbour")
    return candidates.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


# Hash functions per table, tables, and rows of a sample that scales the buckets of the approximate join.
HASHES, TABLES, SCALE_ROWS = 4, 12, 256
# Rows of buckets that one task compares, rows of one bucket beyond which it is cut into blocks, and pairs listed at once.
BUCKET_ROWS, HOT_ROWS, PAIRS_AT_ONCE = 65_536, 16_384, 500_000


def approximate_knn_join(
    queries: DataFrame, base: DataFrame, k: int, seed: int = 42, exclude_self: bool = False, hashes: int = HASHES,
    tables: int = TABLES, width: float | None = None,
) -> DataFrame:
    """Near base rows of every query row by random projections, in the form of :func:`knn_join`.

    MLlib's projections are grouped into ``tables`` keys of ``hashes`` buckets each, and rows that agree in one key
    are compared. ``width`` of a bucket is by default 2.5 times the median distance of the k-th neighbour of
    a bounded sample of base rows, searched among all rows. All pairs that share a key are compared, so the distances
    are exact and only neighbours that share none are missed; :func:`recall` measures how many. Pairs are never
    stored: a bucket is compared where its vectors meet, and keeps the nearest rows of each query.
    """
    spark = base.sparkSession
    wanted = k + 1 if exclude_self else k
    base = as_table(_few_copies(base, wanted, []), "base")
    if width is None:
        picked = base.select("id", "vec", hash_of(F.col("id").cast("string"), seed=seed).alias("h"))
        sample = as_table(picked.orderBy("h").limit(SCALE_ROWS).select("id", "vec"), "sample")
        reach = knn_join(sample, base, k, seed, exclude_self=True).filter(F.col("rank") == k)
        width = 2.5 * (reach.agg(F.median("distance")).first()[0] or 1.0)
    width = max(width, 1e-9)
    # One more, constant coordinate shifts each projection at random, so that no bucket always ends at zero.
    features = array_to_vector(F.concat("vec", F.array(F.lit(1000.0 * width))))
    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="projections", bucketLength=width, numHashTables=hashes * tables, seed=seed
    ).fit(base.select(features.alias("features")))

    def keyed(rows: DataFrame) -> DataFrame:
        found = model.transform(rows.select("id", "vec", features.alias("features")))
        places = F.transform("projections", lambda v: vector_to_array(v)[0])
        keys = F.array(*[F.xxhash64(F.lit(t), F.slice(places, t * hashes + 1, hashes)) for t in range(tables)])
        return as_table(found.select("id", "vec", keys.alias("keys")), "projected")

    left, right = keyed(spread(queries.select("id", "vec"))), keyed(spread(base))
    size = base.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("width")).first()
    asked = left.count()
    kinds = f"id {_type(queries, 'id')}, neighbour {_type(base, 'id')}, distance double"
    if not size["rows"] or not asked:
        return spark.createDataFrame([], f"{kinds}, rank int")
    dims = size["width"]
    counts = [t.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")) for t in (left, right)]
    met = as_table(counts[0].withColumnRenamed("n", "asked").join(counts[1].withColumnRenamed("n", "held"), "key"), "met")
    pairs = met.agg(F.sum(F.col("asked") * F.col("held").cast("double"))).first()[0] or 0.0
    if pairs > float(asked) * size["rows"]:
        # Most pairs share many keys: each is looked at once, and whether it shares one where it is near enough.
        return knn_join(left, right, k, seed, exclude_self, keys=tables)
    large = F.greatest(F.col("asked"), F.col("held")) > HOT_ROWS
    # At most 2 * tables * rows / HOT_ROWS keys.
    hot = {r["key"]: (-(-r["asked"] // HOT_ROWS), -(-r["held"] // HOT_ROWS)) for r in met.filter(large).collect()}
    groups = max(4 * tasks_for(spark), tasks_for(spark, (asked + size["rows"]) * tables, BUCKET_ROWS))
    left, right = (
        _bucketed(t, hot, i, groups).repartition(groups, "bucket").groupBy("bucket") for i, t in enumerate((left, right))
    )
    empty = _empty(kinds)

    def compare(q: pa.Table, b: pa.Table) -> pa.Table:
        if not len(q) or not len(b):
            return empty
        row, place, gaps = _bucket_pairs(q, b, dims, wanted)
        taken = [t.column("id").combine_chunks().take(pa.array(at)) for t, at in ((q, row), (b, place))]
        return pa.Table.from_arrays([*taken, pa.array(gaps, pa.float64())], names=["id", "neighbour", "distance"])

    near = left.cogroup(right).applyInArrow(compare, kinds)
    if exclude_self:
        near = near.filter(F.col("id") != F.col("neighbour"))
    # Each table gives a query at most ``wanted`` rows.
    nearest = F.slice(F.array_sort(F.collect_set(F.struct("distance", "neighbour"))), 1, k)
    found = near.groupBy("id").agg(nearest.alias("near")).select("id", F.posexplode("near").alias("place", "n"))
    return found.select("id", "n.neighbour", "n.distance", (F.col("place") + 1).alias("rank"))


def _bucketed(rows: DataFrame, hot: dict, side: int, groups: int) -> DataFrame:
    """A row for each key with the packed vector. The rows of a hot key are dealt by id into blocks, and each block
    is sent to all blocks of the other side."""
    kind = _type(rows, "id")

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("keys").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), len(flat) // batch.num_rows)
            if hot:
                dealt = batch.column("dealt").to_numpy()
                usual = ~np.isin(flat, list(hot))
                keys, rows_of = [flat[usual]], [row[usual]]
                for at in np.flatnonzero(~usual):
                    blocks = hot[int(flat[at])]
                    mine = np.int64(dealt[row[at]] % blocks[side])
                    others = np.arange(blocks[1 - side])
                    first, second = (mine, others) if side == 0 else (others, mine)
                    with np.errstate(over="ignore"):
                        keys.append((flat[at] + (first + 1) * np.int64(7046029254386353131) + (second + 1) * np.int64(1442695040888963407)).astype(np.int64))
                    rows_of.append(np.full(len(others), row[at]))
                flat, row = np.concatenate(keys), np.concatenate(rows_of)
            x = _matrix(batch.column("vec"), len(batch.column("vec").flatten()) // batch.num_rows)
            packed = pa.array([_bytes(v) for v in x], pa.binary())
            for start in range(0, len(row), 10_000):
                part = slice(start, start + 10_000)
                take = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[part] % groups, pa.int64()), pa.array(flat[part], pa.int64()), batch.column("id").take(take), packed.take(take)],
                    names=["bucket", "key", "id", "vec"],
                )

    dealt = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("dealt")
    return rows.select("id", "vec", "keys", dealt).mapInArrow(unfold, f"bucket long, key long, id {kind}, vec binary")


def _bucket_pairs(q: pa.Table, b: pa.Table, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest base rows of each query row among those of its key: row, base row, rounded distance."""
    keys_q, keys_b = (t.column("key").to_numpy() for t in (q, b))
    x, y = (np.concatenate([_numbers(v, 1, width) for v in t.column("vec").to_pylist()]) for t in (q, b))
    rank = np.empty(len(y), int)
    rank[pc.sort_indices(b.column("id").combine_chunks()).to_numpy()] = np.arange(len(y))
    by_q, by_b = np.argsort(keys_q, kind="stable"), np.argsort(keys_b, kind="stable")
    sorted_q, sorted_b = keys_q[by_q], keys_b[by_b]
    found = []
    # Buckets of many pairs are searched one by one.
    keys, first = np.unique(sorted_q, return_index=True)
    last = np.r_[first[1:], len(sorted_q)]
    low, high = np.searchsorted(sorted_b, keys), np.searchsorted(sorted_b, keys, "right")
    pairs = (last - first) * (high - low)
    many = (pairs > 4096) & (high - low > k)
    for i in np.flatnonzero(many):
        rows, base = by_q[first[i] : last[i]], by_b[low[i] : high[i]]
        row, place, gaps, _ = _search(x[rows], y[base], rank[base], k, np.full(len(rows), np.inf))
        found.append((rows[row], base[place], gaps))
    # The others are listed, some at a time.
    some = np.flatnonzero(~many & (pairs > 0))
    ends = np.cumsum(pairs[some])
    for start, end in _runs(ends, PAIRS_AT_ONCE):
        each = some[start:end]
        of_key = np.repeat(each, (last - first)[each])
        row = np.concatenate([by_q[first[i] : last[i]] for i in each])
        held = (high - low)[of_key]
        place = by_b[np.repeat(low[of_key], held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)]
        row = np.repeat(row, held)
        found.append(_first_of(row, place, _gaps(x, y, row, place), rank, k))
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return tuple(np.concatenate(v) for v in zip(*found))


def _runs(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes, given by their running total, add up to about ``size``."""
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, end
        start = end


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact neighbours whose distance the found ones reach: ties count for each other."""
    last = exact.groupBy("id").agg(F.max("distance").alias("reach"), F.count(F.lit(1)).alias("wanted"))
    hits = found.join(last, "id").filter(F.col("distance") <= F.col("reach")).groupBy("id").agg(
        F.least(F.count(F.lit(1)), F.max("wanted")).alias("hits")
    )
    total = last.agg(F.sum("wanted")).first()[0] or 0
    return (hits.agg(F.sum("hits")).first()[0] or 0) / total if total else 1.0


def vote(neighbours: DataFrame, classes: list, weighted: bool = True) -> DataFrame:
    """Class shares and winner per query from neighbours with a ``label``.

    Weights are 1/distance; a neighbour at distance zero takes all the weight.
    Without weights every neighbour counts once. Ties go to the lower class.
    """
    if weighted:
        exact = F.max(F.when(F.col("distance") == 0, 1).otherwise(0)).over(Window.partitionBy("id"))
        weight = F.when(F.col("exact") == 1, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
        rows = neighbours.withColumn("exact", exact).withColumn("w", weight)
    else:
        rows = neighbours.withColumn("w", F.lit(1.0))
    sums = rows.groupBy("id").agg(
        *[F.sum(F.when(F.col("label") == F.lit(c), F.col("w")).otherwise(0.0)).alias(f"w_{i}")
          for i, c in enumerate(classes)],
        F.sum("w").alias("w_all"),
    )
    shares = F.array(*[F.col(f"w_{i}") / F.col("w_all") for i in range(len(classes))])
    # array_position gives the first place of the maximum: the lower class on ties.
    place = F.array_position(F.col("shares"), F.array_max("shares")) - 1
    labels = F.array(*[F.lit(c) for c in classes])
    return sums.select("id", shares.alias("shares")).withColumn(
        "prediction", F.element_at(labels, (place + 1).cast("int"))
    )


def k_grid(rows: DataFrame, classes: list, ks: list[int], folds: int = 5, seed: int = 42) -> DataFrame:
    """Cross-validated accuracy of the unweighted vote for every k.

    ``rows`` has ``id``, ``vec`` and ``label``. Neighbours are searched once per
    fold with the largest k; smaller k use the same ranks.
    """
    fold = F.pmod(F.conv(F.substring(hash_of(F.col("id").cast("string"), seed=seed), 1, 8), 16, 10)
                  .cast("long"), F.lit(folds)).cast("int")
    rows = cut(rows.withColumn("fold", fold))
    found = None
    for i in range(folds):
        near = knn_join(
            rows.filter(F.col("fold") == i), rows.filter(F.col("fold") != i), max(ks), seed, carry="label"
        )
        found = near if found is None else found.unionByName(near)
    labelled = cut(found)
    truth = rows.select("id", F.col("label").alias("truth"))
    scores = None
    for k in ks:
        hits = vote(labelled.filter(F.col("rank") <= k), classes, weighted=False).join(truth, "id")
        row = hits.agg(
            F.lit(k).alias("k"),
            F.avg((F.col("prediction") == F.col("truth")).cast("double")).alias("accuracy"),
        )
        scores = row if scores is None else scores.unionByName(row)
    return scores


# Parts in which the copies of one training vector are thinned out first.
COPY_PARTS = 256


class _NeighbourParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "class labels", TypeConverters.toListFloat)


class NeighbourClassifier(Estimator, _NeighbourParams, DefaultParamsReadable, DefaultParamsWritable):
    """Distance-weighted vote of the k nearest training rows."""

    def __init__(self, k: int = 5, labelCol: str = "label", featuresCol: str = "features",
                 predictionCol: str = "prediction", probabilityCol: str = "probability"):
        super().__init__()
        self._set(k=k, labelCol=labelCol, featuresCol=featuresCol, predictionCol=predictionCol,
                  probabilityCol=probabilityCol)

    def _fit(self, dataset: DataFrame) -> "NeighbourModel":
        label = F.col(self.getLabelCol()).cast("double")
        vec = vector_to_array(self.getFeaturesCol())
        # Of equal vectors k rows are enough. Copies are numbered, and a hash of content and number chooses
        # among them: labels keep their chances, and how the rows are stored does not matter. First among
        # parts of a vector's copies, then among what the parts kept.
        rows = number_copies(dataset.select(vec.alias("vec"), label.alias("label")), ["vec", "label"])
        kept = cut(rows.withColumn("id", F.xxhash64("vec", "label", "copy_no")))
        kept = kept.withColumn("chance", F.xxhash64("id")).withColumn("part", F.pmod("chance", F.lit(COPY_PARTS)))
        for copies in (("vec", "part"), ("vec",)):
            place = F.row_number().over(Window.partitionBy(*copies).orderBy("chance", "id"))
            kept = kept.withColumn("c", place).filter(F.col("c") <= self.getOrDefault(self.k))
        table = as_table(kept.select("id", "vec", "label"), "neighbours")
        classes = [r[0] for r in table.select("label").distinct().orderBy("label").collect()]
        top = int(max(classes)) + 1 if classes else 0
        model = NeighbourModel(table)
        model._set(
            k=self.getOrDefault(self.k), labelCol=self.getLabelCol(), featuresCol=self.getFeaturesCol(),
            predictionCol=self.getPredictionCol(), probabilityCol=self.getProbabilityCol(),
            classes=[float(c) for c in range(top)],
        )
        return model


class NeighbourModel(TableModel, _NeighbourParams):
    """Training vectors with their labels."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        k, classes = self.getOrDefault(self.k), self.getOrDefault(self.classes)
        keyed = dataset.withColumn("__vec", vector_to_array(self.getFeaturesCol()))
        # Rows with equal features share one search.
        asked = cut(
            keyed.select(F.col("__vec").alias("vec")).distinct()
            .withColumn("id", F.monotonically_increasing_id())
        )
        votes = vote(knn_join(asked, self.table, k, carry="label"), classes)
        answers = votes.join(asked, "id").select(
            F.col("vec").alias("__vec"),
            array_to_vector("shares").alias(self.getProbabilityCol()),
            F.col("prediction").alias(self.getPredictionCol()),
        )
        return lookup_join(keyed, cut(answers), ["__vec"], "left").drop("__vec")


# Send the numpy helpers to the workers with the functions that use them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
