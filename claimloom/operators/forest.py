"""Random forests whose small nodes are grown where their rows are.

Rows are cut into bins once and kept as blocks of bytes. Each tree draws its rows by Poisson counts from the seed, the
tree and the block. A node of more than ``LOCAL_ROWS`` rows is split by histograms that all tasks add up
(compare Panda et al., "PLANET", 2009); the rows of a smaller node are sent to one task, which grows all that is
below it. Histograms of nodes with a handful of rows would be many times larger than the rows themselves.

A split gains ``|L|^2 / wL + |R|^2 / wR - |T|^2 / w`` with sums of classes (Gini) or of the label (variance). Nodes
have MLlib's numbers: the children of ``n`` are ``2n`` and ``2n + 1``.
"""

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed, HasWeightCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.skew import lookup_join
from claimloom.functions.storage import as_table, spread, tasks_for
from claimloom.operators.boosting import bin_edges
from claimloom.operators.encoders import TableModel

ROWS_PER_BLOCK = 25_000
# Blocks whose rows are sent on together.
BLOCKS_AT_ONCE = 16
# Drawn rows of a node that one task grows further, node by node down to so many rows, and then level by level.
LOCAL_ROWS, LEVEL_ROWS = 6_000_000, 250_000
# Nodes whose histograms are added up in one job.
NODES_PER_JOB = 400
# Rows of small nodes that a task grows one after the other.
ROWS_PER_TASK = 1_000_000
# Bytes of trees that are sent to all tasks at a time.
SLICE_BYTES = 48_000_000
# Below this a gain is rounding noise.
NO_GAIN = 1e-9

# A run of nodes below ``root``; ``left`` is -1 in leaves and -2 where the children are pieces of their own.
PIECES = "tree int, root long, feature binary, bin binary, left binary, value binary, cover binary, gain binary"


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    least_rows: int
    features: str
    seed: int
    # Zero for a regression.
    classes: int
    edges: list

    @property
    def outputs(self) -> int:
        return self.classes or 1

    def used(self, tree: int, node: int) -> np.ndarray:
        """Which features a node may split."""
        n = len(self.edges)
        take = {"sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "all": n}.get(self.features)
        take = min(n, max(1, take if take is not None else math.ceil(float(self.features) * n)))
        out = np.zeros(n, bool)
        if take == n:
            return ~out
        # A cheap generator: a forest has millions of nodes.
        out[np.argsort(_mixed(self.seed, tree, node, np.arange(n, dtype=np.uint64)))[:take]] = True
        return out

    def used_by(self, tree: int, nodes: np.ndarray) -> np.ndarray:
        """The same for many nodes: nodes x features."""
        n = len(self.edges)
        take = int(self.used(tree, 1).sum())
        keys = _mixed(self.seed, tree, nodes[:, None], np.arange(n, dtype=np.uint64)[None, :])
        out = np.zeros(keys.shape, bool)
        np.put_along_axis(out, np.argsort(keys, axis=1)[:, :take], True, axis=1)
        return out

    def drawn(self, tree: int, block: int, rows: int) -> np.ndarray:
        """How often the tree draws each row of a block."""
        return np.random.Generator(np.random.PCG64([self.seed, tree, block])).poisson(1.0, rows).astype(np.uint8)


def _mixed(seed: int, tree: int, node, feature) -> np.ndarray:
    """Hashes (splitmix64) that name the place of a feature in a node's random order."""
    with np.errstate(over="ignore"):
        z = (np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
             + np.uint64(tree) * np.uint64(0xBF58476D1CE4E5B9) + np.asarray(node).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
             + feature * np.uint64(0xD6E8FEB86659FD93))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        return z ^ (z >> np.uint64(31))


def _sums(key: np.ndarray, size: int, y: np.ndarray, w: np.ndarray, count: np.ndarray, classes: int) -> tuple:
    """Weight by class, or weight and label times weight, and rows by key."""
    if classes:
        part = np.bincount(key * classes + y, w, size * classes).reshape(size, classes)
    else:
        part = np.column_stack([np.bincount(key, w * y, size), np.bincount(key, w, size)])
    return part, np.bincount(key, count, size)


def _score(part: np.ndarray, classes: int) -> np.ndarray:
    """The sum of squares over the weight: larger is purer."""
    top = (part**2).sum(axis=-1) if classes else part[..., 0] ** 2
    weight = part.sum(axis=-1) if classes else part[..., 1]
    return np.divide(top, weight, out=np.zeros_like(top), where=weight > 0)


def _value(part: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class shares or mean, and weight, of nodes."""
    weight = part.sum(axis=1) if classes else part[:, 1]
    value = part if classes else part[:, :1]
    return np.divide(value, weight[:, None], out=np.zeros_like(value), where=weight[:, None] > 0), weight


def _best_splits(tables: list, total: np.ndarray, rows: np.ndarray, s: Settings) -> tuple:
    """Gain, feature and bin of each node's best split; ``tables`` has per feature (node, bin, sums, rows) by node and bin."""
    m = len(total)
    gain, feature, cut = np.full(m, NO_GAIN), np.full(m, -1), np.zeros(m, int)
    whole = _score(total, s.classes)
    for f, node, place, part, count in tables:
        if not len(node):
            continue
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(node)]))
        left, n_left = part.cumsum(axis=0), count.cumsum()
        left = left - (left[first] - part[first])[of]
        n_left = n_left - (n_left[first] - count[first])[of]
        n_right = rows[node] - n_left
        fits = (n_left >= s.least_rows) & (n_right >= max(1, s.least_rows))
        gains = np.where(fits, _score(left, s.classes) + _score(np.maximum(total[node] - left, 0) if s.classes else total[node] - left, s.classes) - whole[node], -1.0)
        top = np.maximum.reduceat(gains, first)
        at = np.flatnonzero(gains == top[of])
        at = at[np.r_[True, of[at][1:] != of[at][:-1]]]
        better = top > gain[node[at]] * (1 + 1e-12)
        at = at[better]
        gain[node[at]], feature[node[at]], cut[node[at]] = gains[at], f, place[at]
    return gain, feature, cut


def _class_weights(y: np.ndarray, w: np.ndarray, classes: int) -> np.ndarray | None:
    """The weight of each class if all rows of a class weigh the same, as balanced classes do."""
    present, first = np.unique(y, return_index=True)
    out = np.zeros(classes)
    out[present] = w[first]
    return out if np.array_equal(out[y], w) else None


class Drawn:
    """Rows of a tree that are grown together: bins by feature, label, weight and how often each was drawn."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, count: np.ndarray, s: Settings):
        self.x, self.y, self.count, self.classes = np.ascontiguousarray(x.T), y, count, s.classes
        self.by_class = _class_weights(y, w, s.classes) if s.classes else None
        self.w = None if self.by_class is not None else w * count
        # Of weights of one, sums of weights are numbers of rows.
        self.plain = not s.classes and np.array_equal(self.w, count)
        self.wy = None if s.classes else self.w * y

    def __len__(self) -> int:
        return len(self.count)

    def keep(self, rows: np.ndarray) -> None:
        self.x = self.x[:, rows]
        for name in ("y", "w", "count", "wy"):
            if getattr(self, name) is not None:
                setattr(self, name, getattr(self, name)[rows])

    def sums(self, key: np.ndarray, size: int, rows) -> tuple[np.ndarray, np.ndarray]:
        """As :func:`_sums`, of some rows."""
        if self.classes and self.by_class is not None:
            count = np.bincount(key * self.classes + self.y[rows], self.count[rows], size * self.classes).reshape(size, self.classes)
            return count * self.by_class, count.sum(axis=1)
        count = np.bincount(key, self.count[rows], size)
        if self.classes:
            part = np.bincount(key * self.classes + self.y[rows], self.w[rows], size * self.classes)
            return part.reshape(size, self.classes), count
        weight = count if self.plain else np.bincount(key, self.w[rows], size)
        return np.column_stack([np.bincount(key, self.wy[rows], size), weight]), count


def _level_tables(rows: Drawn, at: np.ndarray, m: int, used: np.ndarray, s: Settings) -> Iterator[tuple]:
    """Sums by node and bin for every feature, of the nodes that may split it."""
    for f, edge in enumerate(s.edges):
        bins = len(edge) + 1
        if bins == 1 or not used[:, f].any():
            continue
        some = slice(None) if used[:, f].all() else np.flatnonzero(used[at, f])
        key = at[some] * bins + rows.x[f][some]
        if m * bins <= 4 * len(key):
            part, n = rows.sums(key, m * bins, some)
            keys = np.flatnonzero(n)
            part, n = part[keys], n[keys]
        else:
            # More bins than rows: only those that occur.
            order = np.argsort(key)
            ordered = key[order]
            new = np.r_[True, ordered[1:] != ordered[:-1]]
            keys = ordered[new]
            run = np.empty(len(key), np.int64)
            run[order] = np.cumsum(new) - 1
            part, n = rows.sums(run, len(keys), some)
        yield f, keys // bins, keys % bins, part, n


def _one_split(x, y, w, count, rows: np.ndarray, tree: int, node: int, s: Settings) -> tuple:
    """Sums and best split of one node of many rows, which are added up a part at a time."""
    sizes, used = [len(e) + 1 for e in s.edges], s.used(tree, node)
    tables, total, n = [0.0] * len(sizes), 0.0, 0.0
    for start in range(0, len(rows), LEVEL_ROWS):
        some = rows[start : start + LEVEL_ROWS]
        part = Drawn(x[some], y[some], w[some], count[some], s)
        sums, drawn = part.sums(np.zeros(len(some), np.int64), 1, slice(None))
        total, n = total + sums, n + drawn
        for f in np.flatnonzero(used):
            tables[f] = tables[f] + np.column_stack(part.sums(part.x[f].astype(np.int64), sizes[f], slice(None)))
    found = []
    for f in np.flatnonzero(used):
        kept = np.flatnonzero(tables[f][:, -1])
        found.append((f, np.zeros(len(kept), int), kept, tables[f][kept, :-1], tables[f][kept, -1]))
    return total, n, *_best_splits(found, total, n, s)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, count: np.ndarray, tree: int, root: int, s: Settings) -> dict:
    """All nodes below ``root`` from its rows. Large nodes are split one after the other, all below a smaller one by levels."""
    if len(x) <= LEVEL_ROWS:
        return _grow_levels(x, y, w, count, tree, root, s)
    out: dict[str, list] = {name: [None] for name in ("feature", "bin", "left", "value", "cover", "gain")}
    stack = [(root, 0, np.arange(len(x), dtype=np.int32))]
    while stack:
        node, place, rows = stack.pop()
        if len(rows) <= LEVEL_ROWS or node.bit_length() - 1 >= s.depth:
            below = _grow_levels(x[rows], y[rows], w[rows], count[rows], tree, node, s)
            made = len(out["left"]) - 1
            for name, v in below.items():
                v = np.where(v >= 0, v + made, v) if name == "left" else v
                out[name][place] = v[0]
                out[name].extend(v[1:])
            continue
        total, n, gain, feature, cut = _one_split(x, y, w, count, rows, tree, node, s)
        value, cover = _value(total, s.classes)
        splits = feature[0] >= 0
        left = len(out["left"]) if splits else -1
        for name, v in (("feature", feature[0]), ("bin", cut[0]), ("left", left), ("value", value[0]), ("cover", cover[0]),
                        ("gain", gain[0] if splits else 0.0)):
            out[name][place] = v
            out[name].extend([None, None] if splits else [])
        if splits:
            right = x[rows, feature[0]] > cut[0]
            stack += [(2 * node + 1, left + 1, rows[right]), (2 * node, left, rows[~right])]
    return {name: np.array(v) for name, v in out.items()}


def _grow_levels(x: np.ndarray, y: np.ndarray, w: np.ndarray, count: np.ndarray, tree: int, root: int, s: Settings) -> dict:
    """All nodes below ``root`` from its rows, level by level."""
    drawn = Drawn(x, y, w, count, s)
    at = np.zeros(len(x), np.int64)
    numbers = np.array([root], np.int64)
    out: dict[str, list] = {name: [] for name in ("feature", "bin", "left", "value", "cover", "gain")}
    made = 1
    for _ in range(root.bit_length() - 1, s.depth + 1):
        m = len(numbers)
        total, rows = drawn.sums(at, m, slice(None))
        value, cover = _value(total, s.classes)
        gain, feature, cut = np.zeros(m), np.full(m, -1), np.zeros(m, int)
        open_ = (rows >= 2 * s.least_rows) & (rows > 1)
        if int(numbers[0]).bit_length() - 1 < s.depth and open_.any():
            tables = _level_tables(drawn, at, m, s.used_by(tree, numbers) & open_[:, None], s)
            gain, feature, cut = _best_splits(tables, total, rows, s)
        splits = feature >= 0
        left = np.full(m, -1)
        left[splits] = made + 2 * np.arange(splits.sum())
        made += 2 * int(splits.sum())
        for name, v in (("feature", feature), ("bin", cut), ("left", left), ("value", value), ("cover", cover), ("gain", np.where(splits, gain, 0.0))):
            out[name].append(v)
        if not splits.any():
            break
        place = np.cumsum(splits) - 1
        going = np.flatnonzero(splits[at])
        here = at[going]
        right = drawn.x.ravel().take(feature[here] * len(drawn) + going) > cut[here]
        at = 2 * place[here] + right
        # Rows of a node stay together, so that their sums stay in the cache.
        order = np.argsort(at.astype(np.uint16) if 2 * splits.sum() <= 65_536 else at, kind="stable")
        drawn.keep(going[order])
        at = at[order]
        numbers = (2 * numbers[splits][:, None] + np.arange(2)).ravel()
    return {name: np.concatenate(v) for name, v in out.items()}


KINDS = {"feature": np.int8, "bin": np.uint8, "left": np.int32, "value": float, "cover": float, "gain": float}


def _packed(tree: int, root: int, nodes: dict) -> tuple:
    return (tree, root, *(np.ascontiguousarray(nodes[n], k).tobytes() for n, k in KINDS.items()))


def _unpacked(row: dict, outputs: int) -> dict:
    nodes = {n: np.frombuffer(bytes(row[n]), k) for n, k in KINDS.items() if n in row}
    if "value" in nodes:
        nodes["value"] = nodes["value"].reshape(-1, outputs)
    return nodes


def _routed(x: np.ndarray, top: dict) -> np.ndarray:
    """The node without a split in ``top`` that each row reaches from the root."""
    at = np.ones(len(x), np.int64)
    if not top:
        return at
    nodes = np.array(sorted(top))
    feature, cut = np.array([top[n] for n in nodes.tolist()]).T
    moving, place = np.arange(len(x)), np.zeros(len(x), np.int64)
    while len(moving):
        child = 2 * nodes[place] + (x[moving, feature[place]] > cut[place])
        at[moving] = child
        place = np.minimum(np.searchsorted(nodes, child), len(nodes) - 1)
        inner = nodes[place] == child
        moving, place = moving[inner], place[inner]
    return at


def _binned(x: np.ndarray, edges: list) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]).astype(np.uint8)


def _blocks(rows: DataFrame, edges: list, classes: int) -> DataFrame:
    """Rows as stored blocks of bins, label and weight."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
            bins = _binned(flat.reshape(batch.num_rows, len(edges)), edges)
            y = batch.column(1).to_numpy().astype(np.uint8 if classes else float)
            w = batch.column(2).to_numpy().astype(float)
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = slice(start, start + ROWS_PER_BLOCK)
                columns = [[np.ascontiguousarray(v[part]).tobytes()] for v in (bins, y, w)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["x", "y", "w"])

    found = rows.select("x", "y", "w").mapInArrow(cut, "x binary, y binary, w binary")
    return as_table(found.withColumn("block", F.monotonically_increasing_id()), "forest-blocks")


def _open_block(row: dict, s: Settings) -> tuple:
    y = np.frombuffer(row["y"], np.uint8 if s.classes else float)
    x = np.frombuffer(row["x"], np.uint8).reshape(len(y), len(s.edges))
    return x, y.astype(np.int64) if s.classes else y, np.frombuffer(row["w"], float)


def _histograms(blocks: DataFrame, nodes: list[tuple[int, int]], tops: dict, s: Settings) -> list:
    """The best split and the sums of each (tree, node), by histograms over all rows."""
    width = s.classes or 2
    wanted: dict[int, list[int]] = {}
    for tree, node in nodes:
        wanted.setdefault(tree, []).append(node)
    sizes = [len(e) + 1 for e in s.edges]

    starts = np.cumsum([0, *sizes])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {tree: np.zeros((len(of), starts[-1], width + 1)) for tree, of in wanted.items()}
        asked = {tree: np.array(sorted(of)) for tree, of in wanted.items()}
        used = {tree: s.used_by(tree, of) for tree, of in asked.items()}
        some = False
        for batch in batches:
            for row in batch.to_pylist():
                some = True
                x, y, w = _open_block(row, s)
                for tree, of in asked.items():
                    drawn = s.drawn(tree, row["block"], len(x))
                    here = np.flatnonzero(drawn)
                    at = _routed(x[here], tops.get(tree, {}))
                    slot = np.minimum(np.searchsorted(of, at), len(of) - 1)
                    inside = of[slot] == at
                    here, slot = here[inside], slot[inside]
                    order = np.argsort(slot, kind="stable")
                    here, slot = here[order], slot[order]
                    rows = Drawn(x[here], y[here], w[here], drawn[here].astype(float), s)
                    for f, size in enumerate(sizes):
                        mine = used[tree][:, f]
                        if not mine.any():
                            continue
                        of_rows = slice(None) if mine.all() else np.flatnonzero(mine[slot])
                        part, count = rows.sums(slot[of_rows] * size + rows.x[f][of_rows], len(of) * size, of_rows)
                        total = sums[tree][:, starts[f] : starts[f + 1]]
                        total[:, :, :width] += part.reshape(len(of), size, width)
                        total[:, :, width] += count.reshape(len(of), size)
        if some:
            for tree, of in asked.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(of), tree), pa.int32()), pa.array(of, pa.int64()),
                     pa.array([v.tobytes() for v in sums[tree]], pa.binary())],
                    names=["tree", "node", "sums"],
                )

    def choose(group: pa.Table) -> pa.Table:
        tree, node = group["tree"][0].as_py(), group["node"][0].as_py()
        # In a fixed order, so that rounding does not depend on the shuffle.
        parts = sorted(group["sums"].to_pylist())
        found = sum(np.frombuffer(b, float) for b in parts).reshape(-1, width + 1)
        used, tables = s.used(tree, node), []
        # Only features that the node may split are summed.
        first = found[slice(*starts[np.flatnonzero(used)[0] :][:2])]
        total, rows = first[:, :width].sum(axis=0)[None], first[:, width].sum()[None]
        for f in np.flatnonzero(used):
            part = found[starts[f] : starts[f + 1]]
            some = np.flatnonzero(part[:, width])
            tables.append((f, np.zeros(len(some), int), some, part[some, :width], part[some, width]))
        gain, feature, cut = _best_splits(tables, total, rows, s)
        left = 0.0
        if feature[0] >= 0:
            left = float(found[starts[feature[0]] : starts[feature[0]] + cut[0] + 1, width].sum())
        value, cover = _value(total, s.classes)
        values = [tree, node, int(feature[0]), int(cut[0]), float(gain[0]), left, float(rows[0]), float(cover[0]), value[0].tolist()]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.list_(pa.float64())]
        names = ["tree", "node", "feature", "bin", "gain", "left", "rows", "cover", "value"]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    # One row per node.
    return blocks.mapInArrow(add, "tree int, node long, sums binary").groupBy("tree", "node").applyInArrow(
        choose, "tree int, node long, feature int, bin int, gain double, left double, rows double, cover double, value array<double>"
    ).collect()


def _node_rows(blocks: DataFrame, open_nodes: dict, tops: dict, s: Settings) -> DataFrame:
    """The drawn rows of all nodes that tasks grow further, as pieces of blocks."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _blocks_together(batches, s):
            number, xs, ys, ws = group[0][0], *(np.concatenate([g[i] for g in group]) for i in (1, 2, 3))
            for tree, of in open_nodes.items():
                drawn = np.concatenate([s.drawn(tree, block, len(x)) for block, x, _, _ in group])
                here = np.flatnonzero(drawn)
                at, of = _routed(xs[here], tops.get(tree, {})), np.array(sorted(of))
                slot = np.minimum(np.searchsorted(of, at), len(of) - 1)
                inside = of[slot] == at
                here, slot = here[inside], slot[inside]
                order = np.argsort(slot, kind="stable")
                here, slot = here[order], slot[order]
                if not len(here):
                    continue
                first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
                label = ys[here].astype(np.uint8) if s.classes else ys[here]
                columns = [[xs[here], label, drawn[here]], ws[here]]
                ends = [*first[1:], len(here)]
                pieces = [[np.ascontiguousarray(c[a:z]).tobytes() for a, z in zip(first, ends)] for c in columns[0]]
                weights = [_sent_weights(ys[here[a:z]], columns[1][a:z], s.classes) for a, z in zip(first, ends)]
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, tree), pa.int32()), pa.array(of[slot[first]], pa.int64()), pa.array(np.full(n, number), pa.int64()),
                     *(pa.array(c, pa.binary()) for c in (pieces[0], pieces[1], weights, pieces[2]))],
                    names=["tree", "root", "block", "x", "y", "w", "n"],
                )

    return blocks.mapInArrow(send, "tree int, root long, block long, x binary, y binary, w binary, n binary")


def _blocks_together(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[list[tuple]]:
    """A few blocks at a time: number, bins, label and weight."""
    group: list[tuple] = []
    for batch in batches:
        for row in batch.to_pylist():
            group.append((row["block"], *_open_block(row, s)))
            if len(group) == BLOCKS_AT_ONCE:
                yield group
                group = []
    if group:
        yield group


def _sent_weights(y: np.ndarray, w: np.ndarray, classes: int) -> bytes:
    """Weights of rows: one for all or one per class where that says it, after a byte that tells which."""
    if (w == w[0]).all():
        return b"a" + w[:1].tobytes()
    found = _class_weights(y, w, classes) if classes else None
    return b"r" + np.ascontiguousarray(w).tobytes() if found is None else b"c" + found.tobytes()


def _read_weights(data: bytes, y: np.ndarray) -> np.ndarray:
    found = np.frombuffer(data[1:])
    return {b"a": lambda: np.full(len(y), found[0]), b"c": lambda: found[y], b"r": lambda: found}[data[:1]]()


def fit(rows: DataFrame, s: Settings) -> DataFrame:
    """The pieces of all trees from rows with ``x`` (array), ``y`` and ``w``."""
    spark = rows.sparkSession
    blocks = _blocks(rows, s.edges, s.classes)
    blocks = spread(blocks)
    total = rows.count()
    tops: dict[int, dict] = {}
    small: dict[int, list[int]] = {}
    large = [(t, 1) for t in range(s.trees)] if total > LOCAL_ROWS else []
    if not large:
        small = {t: [1] for t in range(s.trees)}
    pieces, local_rows = [], float(total) * s.trees if not large else 0.0
    while large:
        following = []
        for start in range(0, len(large), NODES_PER_JOB):
            for r in _histograms(blocks, large[start : start + NODES_PER_JOB], tops, s):
                splits = r["feature"] >= 0 and r["node"].bit_length() - 1 < s.depth
                nodes = {
                    "feature": [r["feature"] if splits else -1], "bin": [r["bin"]], "left": [-2 if splits else -1],
                    "value": [r["value"]], "cover": [r["cover"]], "gain": [r["gain"] if splits else 0.0],
                }
                pieces.append(_packed(r["tree"], r["node"], nodes))
                if not splits:
                    continue
                following.append((r["tree"], r["node"], r["feature"], r["bin"], r["left"], r["rows"] - r["left"]))
        large = []
        for tree, node, feature, cut, *sides in sorted(following):
            tops.setdefault(tree, {})[node] = (feature, cut)
            for child, n in zip((2 * node, 2 * node + 1), sides):
                if n > LOCAL_ROWS:
                    large.append((tree, child))
                else:
                    small.setdefault(tree, []).append(child)
                    local_rows += n
    keys = sum(map(len, small.values()))
    sent = _node_rows(blocks, small, tops, s)

    def below(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        joined = {c: b"".join(group[c].to_pylist()) for c in ("x", "y", "n")}
        n = np.frombuffer(joined["n"], np.uint8).astype(float)
        x = np.frombuffer(joined["x"], np.uint8).reshape(len(n), len(s.edges))
        y = np.frombuffer(joined["y"], np.uint8).astype(np.int64) if s.classes else np.frombuffer(joined["y"], float)
        tree, root = group["tree"][0].as_py(), group["root"][0].as_py()
        ends = np.cumsum([len(v) for v in group["n"].to_pylist()])
        w = np.concatenate([_read_weights(v, part) for v, part in zip(group["w"].to_pylist(), np.split(y, ends[:-1]))])
        nodes = grow(x, y, w, n, tree, root, s)
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * len(KINDS)]
        names = ["tree", "root", *KINDS]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(_packed(tree, root, nodes), kinds)], names=names)

    tasks = min(max(keys, 1), max(4 * spark.sparkContext.defaultParallelism, tasks_for(spark, local_rows, ROWS_PER_TASK)))
    grown = sent.repartition(tasks, "tree", "root").groupBy("tree", "root").applyInArrow(below, PIECES)
    if pieces:
        # One row per node of more than LOCAL_ROWS rows.
        grown = grown.unionByName(spark.createDataFrame(pieces, PIECES))
    return as_table(grown, "forest")


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows per leaf", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features per split", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes, zero for a number", TypeConverters.toInt)
    edges = Param(Params._dummy(), "edges", "upper edges of the bins of each feature", TypeConverters.identity)

    def _defaults(self, given: dict) -> None:
        self._setDefault(
            numTrees=20, maxDepth=5, minInstancesPerNode=1, featureSubsetStrategy="all", maxBins=32, seed=42,
            featuresCol="features", labelCol="label", predictionCol="prediction",
        )
        if self.hasParam("probabilityCol"):
            self._setDefault(probabilityCol="probability")
        self._set(**{k: v for k, v in given.items() if v is not None})


class _Forest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    classifies = True

    def _fit(self, dataset: DataFrame) -> "ForestModel":
        get = self.getOrDefault
        weighted = self.isSet(self.weightCol) and self.getWeightCol() in dataset.columns
        weight = F.col(self.getWeightCol()).cast("double") if weighted else F.lit(1.0)
        rows = as_table(
            dataset.select(
                vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w")
            ),
            "forest-rows", split=True,
        )
        facts = rows.agg(F.max(F.size("x")).alias("width"), F.max("y").alias("top")).first()
        if facts["width"] is None:
            raise ValueError("no rows to fit")
        classes = int(facts["top"]) + 1 if self.classifies else 0
        edges = bin_edges(rows, facts["width"], get(self.maxBins))
        settings = Settings(
            get(self.numTrees), get(self.maxDepth), get(self.minInstancesPerNode), get(self.featureSubsetStrategy),
            get(self.seed), classes, edges,
        )
        model = (ForestClassificationModel if self.classifies else ForestModel)(fit(rows, settings))
        model._set(
            numTrees=settings.trees, classes=classes, edges=[[float(v) for v in e] for e in edges],
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
        )
        if self.classifies:
            model._set(probabilityCol=self.getProbabilityCol())
        return model


class ForestClassifier(_Forest, HasProbabilityCol):
    """Random forest whose trees vote with their class shares."""

    @keyword_only
    def __init__(self, *, numTrees=None, maxDepth=None, minInstancesPerNode=None, featureSubsetStrategy=None, maxBins=None,
                 seed=None, featuresCol=None, labelCol=None, weightCol=None, predictionCol=None, probabilityCol=None):
        super().__init__()
        self._defaults(self._input_kwargs)


class ForestRegressor(_Forest):
    """Random forest that predicts the mean of its trees."""

    classifies = False

    @keyword_only
    def __init__(self, *, numTrees=None, maxDepth=None, minInstancesPerNode=None, featureSubsetStrategy=None, maxBins=None,
                 seed=None, featuresCol=None, labelCol=None, weightCol=None, predictionCol=None):
        super().__init__()
        self._defaults(self._input_kwargs)


def _votes(x: np.ndarray, pieces: list[dict], tops: dict, outputs: int) -> np.ndarray:
    """Sums of the leaf values that rows of bins reach in some pieces."""
    out = np.zeros((len(x), outputs))
    reached: dict[int, np.ndarray] = {}
    for piece in pieces:
        tree = piece["tree"]
        if tree in tops and tree not in reached:
            reached = {tree: _routed(x, tops[tree])}
        rows = np.flatnonzero(reached[tree] == piece["root"]) if tree in tops else np.arange(len(x))
        at = np.zeros(len(rows), np.int64)
        left, feature, cut = piece["left"], piece["feature"], piece["bin"]
        moving = np.flatnonzero(left[at] >= 0)
        while len(moving):
            here = at[moving]
            at[moving] = left[here] + (x[rows[moving], feature[here]] > cut[here])
            moving = moving[left[at[moving]] >= 0]
        out[rows] += piece["value"][at]
    return out


class ForestModel(TableModel, _ForestParams):
    """Fitted trees as a table of pieces."""

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    @property
    def _outputs(self) -> int:
        return self.getOrDefault(self.classes) or 1

    def nodes(self) -> DataFrame:
        """One row per node: tree, node, left, right, feature, threshold, cover, gain and value."""
        edges, outputs = [np.array(e, float) for e in self.getOrDefault(self.edges)], self._outputs
        names = ("tree", "node", "left", "right", "feature", "threshold", "cover", "gain", "value")

        def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    p = _unpacked(row, outputs)
                    n = len(p["feature"])
                    number = np.full(n, row["root"], np.int64)
                    for i in np.flatnonzero(p["left"] >= 0):
                        number[p["left"][i] : p["left"][i] + 2] = 2 * number[i], 2 * number[i] + 1
                    inner = p["left"] != -1
                    threshold = [edges[f][b] if f >= 0 else None for f, b in zip(p["feature"], p["bin"])]
                    left = np.where(inner, 2 * number, -1)
                    values = [np.full(n, row["tree"]), number, left, np.where(inner, left + 1, -1), p["feature"], threshold, p["cover"], p["gain"], list(p["value"])]
                    kinds = [*[pa.int32()] * 5, *[pa.float64()] * 3, pa.list_(pa.float64())]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=list(names))

        return self.table.mapInArrow(
            unfold, "tree int, node int, left int, right int, feature int, threshold double, cover double, gain double, value array<double>"
        )

    @property
    def featureImportances(self) -> np.ndarray:
        """Mean over trees of each feature's share in the gain of the tree's splits."""
        n = len(self.getOrDefault(self.edges))
        splits = self.nodes().filter("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        out = np.zeros((self.getNumTrees, n))
        # Trees times features.
        for r in splits.collect():
            out[r["tree"], r["feature"]] = r["gain"]
        total = out.sum(axis=1, keepdims=True)
        mean = np.divide(out, total, out=np.zeros_like(out), where=total > 0).sum(axis=0)
        return mean / mean.sum() if mean.sum() else mean

    def _slices(self) -> list[DataFrame]:
        """The pieces in parts of about ``SLICE_BYTES``, dealt by hash of the tree."""
        size = self.table.agg(F.sum(F.length("feature") * (14 + 8 * self._outputs))).first()[0] or 0
        count = max(1, math.ceil(size / SLICE_BYTES))
        of = F.pmod(F.xxhash64("tree", "root"), F.lit(count))
        used = self.table.filter(F.length("left") > 0).select("tree", "root", "feature", "bin", "left", "value")
        return [used.filter(of == i) for i in range(count)]

    def _tops(self) -> dict:
        """Splits of the nodes whose children are pieces of their own."""
        tops: dict[int, dict] = {}
        outer = F.col("left") == F.lit(np.int32(-2).tobytes())
        # One row per node of more than LOCAL_ROWS rows.
        for row in self.table.filter(outer).select("tree", "root", "feature", "bin").collect():
            p = _unpacked(row.asDict(), 1)
            tops.setdefault(row["tree"], {})[row["root"]] = (int(p["feature"][0]), int(p["bin"][0]))
        return tops

    def _transform(self, dataset: DataFrame) -> DataFrame:
        edges, outputs = [np.array(e, float) for e in self.getOrDefault(self.edges)], self._outputs
        tops, trees = self._tops(), self.getNumTrees
        slices = self._slices()

        def pieces_of(table: DataFrame):
            rows = [{"tree": r["tree"], "root": r["root"], **_unpacked(r.asDict(), outputs)} for r in table.collect()]
            return dataset.sparkSession.sparkContext.broadcast(sorted(rows, key=lambda p: (p["tree"], p["root"])))

        def adder(shared):
            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
                    x = _binned(flat.reshape(batch.num_rows, len(edges)), edges)
                    known = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, outputs)
                    total = known + _votes(x, shared.value, tops, outputs)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(total), pa.list_(pa.float64()))], names=["__vec", "__sums"])

            return add

        # Rows with equal features are answered once; trees come to them in slices of bounded size.
        keyed = dataset.withColumn("__vec", vector_to_array(self.getFeaturesCol()))
        empty = F.array_repeat(F.lit(0.0), outputs)
        state = as_table(keyed.select("__vec").distinct().withColumn("__sums", empty), "forest-vectors")
        state = spread(state, state.count() * trees, 10_000_000)
        for part in slices:
            shared = pieces_of(part)
            state = as_table(state.mapInArrow(adder(shared), "__vec array<double>, __sums array<double>"), "forest-votes")
            shared.unpersist()
        joined = lookup_join(keyed, state, ["__vec"], "left")
        shares = F.transform("__sums", lambda v: v / trees)
        if self.getOrDefault(self.classes):
            best = F.array_position(F.col("__sums"), F.array_max("__sums")) - 1
            joined = joined.withColumn(self.getProbabilityCol(), array_to_vector(shares)).withColumn(self.getPredictionCol(), best.cast("double"))
        else:
            joined = joined.withColumn(self.getPredictionCol(), F.get(shares, F.lit(0)))
        return joined.select(*dataset.columns, *[c for c in joined.columns if c not in (*dataset.columns, "__vec", "__sums")])


class ForestClassificationModel(ForestModel, HasProbabilityCol):
    """The same with class shares."""


# Workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
