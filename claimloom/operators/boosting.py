"""Gradient boosting: with softmax one regression tree per class and round, for a number one tree per round.

Rows are cut into bins once and kept as blocks of bytes. A level of all trees of a round is one job: every task
adds up gradients and curvatures by class, node and bin of its blocks, and the driver finds the best splits from
the totals. Of two siblings only the lighter one is summed; the other is what its parent has besides. Scores of rows
live in the blocks; the first job of a round adds the trees of the one before. Trees are stored every few
rounds, and a fit that finds trees of the same data and settings goes on from them.

Formulas (Chen and Guestrin, "XGBoost", 2016): a leaf is ``-G / (H + L2)`` and a split gains
``(GL^2 / (HL + L2) + GR^2 / (HR + L2) - G^2 / (H + L2)) / 2``. A number is fitted as MLlib does it (Friedman, "Greedy
function approximation", 2001): squared error without L2, the first tree in full.
"""

import hashlib
import json
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table, drop_checkpoint, shared_folder

L2 = 1.0
ROWS_PER_BLOCK, LEAST_ROWS = 25_000, 5_000
# Rows of a task at most, as its blocks are stored together.
ROWS_PER_TASK = 4_000_000
# Rounds between losses, and between checkpoints.
LOSS_ROUNDS, CHECKPOINT_ROUNDS = 4, 40
STORED_ROUNDS = 20
# Sums of up to so many tasks are added up on the driver; those of more in other tasks first.
MERGED_TASKS = 16
# Nodes of a class whose sums meet in one task.
NODES_PER_KEY = 16
# Gains that differ by less, as a share, differ by rounding.
ROUNDING = 1e-12

STORED = (
    "round int, class int, node int, left int, right int, feature int, threshold double, bin int, "
    "cover double, gain double, value double"
)


@dataclass(frozen=True)
class Settings:
    # Zero for a number.
    classes: int
    rounds: int = 400
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.9
    # Of features that a tree may split; for a number that a node may split.
    feature_share: float = 0.9
    least_weight: float = 1.0
    max_bins: int = 256
    seed: int = 42

    @property
    def outputs(self) -> int:
        return self.classes or 1

    @property
    def penalty(self) -> float:
        return L2 if self.classes else 0.0

    def rate_of(self, number: int) -> float:
        return self.rate if self.classes or number else 1.0


@dataclass
class Tree:
    """Nodes as lists; children are -1 in leaves. A row goes left if its bin is at most ``bin``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, gain: float) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = left, left + 1
        for name, empty in (("feature", -1), ("bin", -1), ("left", -1), ("right", -1), ("cover", 0.0), ("gain", 0.0), ("value", 0.0)):
            getattr(self, name).extend([empty, empty])
        return left, left + 1

    def packed(self) -> "Packed":
        return Packed(self)


class Packed:
    """A tree as arrays for tasks. Right children follow the left ones; leaves lead to themselves."""

    def __init__(self, tree: Tree):
        feature, left = np.array(tree.feature, np.int16), np.array(tree.left, np.int32)
        leaf = left < 0
        self.feature = np.where(leaf, 0, feature).astype(np.int16)
        self.bin = np.where(leaf, 255, np.array(tree.bin)).astype(np.uint8)
        self.left = np.where(leaf, np.arange(len(left)), left).astype(np.int32)
        self.value = np.array(tree.value)
        level = np.zeros(len(left), int)
        for node in np.flatnonzero(~leaf):
            level[left[node] : left[node] + 2] = level[node] + 1
        self.depth = int(level.max())

    def places(self, x: np.ndarray) -> np.ndarray:
        """The node that each row of bins (features x rows) ends in."""
        n = x.shape[1]
        at = np.zeros(n, np.intp)
        if not self.depth:
            return at
        flat, row = x.ravel(), np.arange(n)
        offset, left = self.feature.astype(np.intp) * n, self.left.astype(np.intp)
        at = left[0] + (x[self.feature[0]] > self.bin[0])
        for _ in range(self.depth - 1):
            place = offset.take(at)
            place += row
            right = flat.take(place) > self.bin.take(at)
            at = left.take(at)
            at += right
        return at

    def values_of(self, x: np.ndarray) -> np.ndarray:
        return self.value.take(self.places(x))


@dataclass(frozen=True)
class Block:
    """Rows that are handled together: bins (features x rows), label, weight and scores (outputs x rows). They travel as plain tuples."""

    number: tuple[int, int]
    x: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    scores: np.ndarray

    def with_rounds(self, rounds: list[list[Packed]]) -> "Block":
        scores = self.scores.copy()
        for trees in rounds:
            for c, tree in enumerate(trees):
                scores[c] += tree.values_of(self.x)
        return replace(self, scores=scores)

    def gradients(self, weight: np.ndarray, settings: Settings, number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Gradient and curvature by output, one after the other."""
        if not settings.classes:
            yield (2 if number else 1) * (self.scores[0] - self.label) * weight, weight
            return
        p = np.exp(self.scores - self.scores.max(axis=0))
        p /= p.sum(axis=0)
        for c, share in enumerate(p):
            yield (share - (self.label == c)) * weight, np.maximum(share * (1 - share), 1e-16) * weight

    def loss(self, classes: int) -> float:
        if not classes:
            return float((self.weight * (self.scores[0] - self.label) ** 2).sum())
        top = self.scores.max(axis=0)
        total = top + np.log(np.exp(self.scores - top).sum(axis=0))
        return float((self.weight * (total - self.scores[self.label, np.arange(len(top))])).sum())


def bin_edges(rows: DataFrame, n_features: int, max_bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: all different values if few, else even shares of the rows."""
    x = F.col("x")
    values = as_table(
        rows.select(F.posexplode("x").alias("i", "v")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")), "values"
    )
    few = values.groupBy("i").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") <= max_bins)
    edges: list = [None] * n_features
    for r in values.join(F.broadcast(few), "i").groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("v")).collect():
        edges[r["i"]] = np.array(r["v"][:-1])
    many = [i for i in range(n_features) if edges[i] is None]
    if many:
        shares = [k / max_bins for k in range(1, max_bins)]
        found = rows.agg(*[F.percentile_approx(x[i], shares, 20 * max_bins).alias(f"e{i}") for i in many]).first()
        for i in many:
            edges[i] = np.unique(np.array(found[f"e{i}"] or [], float))
    return edges


def _blocks(rows: DataFrame, edges: list[np.ndarray], settings: Settings, parts: int) -> RDD:
    """Rows as blocks of bins, spread evenly."""
    width, kind = len(edges), np.uint8 if settings.classes else float

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, width)
            bins = np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]).astype(np.uint8)
            columns = [bins, batch.column(1).to_numpy().astype(kind), batch.column(2).to_numpy().astype(float)]
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = [[np.ascontiguousarray(v[start : start + ROWS_PER_BLOCK]).tobytes()] for v in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in part], names=["x", "label", "weight"])

    def joined(pieces: list) -> tuple:
        x, label, weight = (b"".join(bytes(p[c]) for p in pieces) for c in ("x", "label", "weight"))
        label = np.frombuffer(label, kind)
        x = np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(len(label), width).T)
        return x, label, np.frombuffer(weight, float), np.zeros((settings.outputs, len(label)))

    def numbered(part: int, rows: Iterator) -> Iterator[tuple]:
        # Arrow's batches may be shorter than a block.
        k, pieces, size = 0, [], 0
        for row in rows:
            n = len(row["weight"]) // 8
            if pieces and size + n > ROWS_PER_BLOCK:
                yield (part, k), *joined(pieces)
                k, pieces, size = k + 1, [], 0
            pieces.append(row)
            size += n
        if pieces:
            yield (part, k), *joined(pieces)

    # In the order of the stored rows, so that a lost block comes back as it was.
    dealt = rows.repartition(parts, F.xxhash64("__n")).sortWithinPartitions("__n").select("x", "label", "weight")
    return dealt.mapInArrow(cut, "x binary, label binary, weight binary").rdd.mapPartitionsWithIndex(numbered)


def _advanced(state: RDD, rounds: list[list[Tree]]) -> RDD:
    """Blocks with the scores of more rounds."""
    packed = [[tree.packed() for tree in trees] for trees in rounds]

    def advance(block: tuple) -> tuple:
        return tuple(vars(Block(*block).with_rounds(packed)).values())

    return state.map(advance).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: Iterator[tuple], trees: list[Packed], wanted: list[list[int]], starts: np.ndarray,
          used: list[list[int]], settings: Settings, number: int) -> Iterator[tuple]:
    """Gradient and curvature of each wanted node by bin, summed over the blocks of a task."""
    size = int(starts[-1])
    totals = [np.zeros((2, len(nodes), size)) for nodes in wanted]
    for block in blocks:
        block = Block(*block)
        draw = np.random.Generator(np.random.PCG64([settings.seed, number, *block.number]))
        # A row that is not drawn weighs nothing.
        weight = block.weight * (draw.random(len(block.label)) < settings.row_share)
        for c, values in enumerate(block.gradients(weight, settings, number)):
            nodes = wanted[c]
            if not nodes:
                continue
            rows, slot = slice(None), 0
            if trees[c].depth:
                slots = np.full(len(trees[c].feature), -1)
                slots[nodes] = np.arange(len(nodes))
                slot = slots.take(trees[c].places(block.x))
                rows = np.flatnonzero(slot >= 0)
                slot = slot.take(rows)
            values = [v[rows] for v in values]
            for i in used[c]:
                bins = int(starts[i + 1] - starts[i])
                key = slot * bins + block.x[i][rows]
                for total, v in zip(totals[c], values):
                    total[:, starts[i] : starts[i + 1]] += np.bincount(key, v, len(nodes) * bins).reshape(-1, bins)
    for c, total in enumerate(totals):
        for first in range(0, total.shape[1], NODES_PER_KEY):
            yield (c, first), total[:, first : first + NODES_PER_KEY]


def _added(sent: RDD, parts: int, keys: int) -> dict:
    """Sums of all tasks by class and first node: for each node two numbers per bin."""
    if parts > MERGED_TASKS:
        sent = sent.reduceByKey(np.add, min(keys, parts))
    merged: dict = {}
    for key, total in sent.collect():
        merged[key] = merged[key] + total if key in merged else total
    return merged


def _best(total: np.ndarray, starts: np.ndarray, allowed: np.ndarray, settings: Settings) -> list[tuple]:
    """(gain, feature, bin, G, H, G left, H left) of each node; feature -1 if no split gains.

    ``total`` has gradients and curvatures by node and bin, ``allowed`` the features that a node may split.
    """
    least, penalty = settings.least_weight, settings.penalty
    first = int(np.flatnonzero(allowed.any(axis=0))[0])
    g, h = total[:, :, starts[first] : starts[first + 1]].sum(axis=2)
    out = np.zeros((len(g), 5))
    out[:, 1:3] = -1
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = g**2 / (h + penalty)
        for i in np.flatnonzero(allowed.any(axis=0)):
            gl, hl = total[:, :, starts[i] : starts[i + 1]].cumsum(axis=2)[:, :, :-1]
            if not gl.shape[1]:
                continue
            gr, hr = g[:, None] - gl, h[:, None] - hl
            gains = (gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - whole[:, None]) / 2
            gains[(hl < least) | (hr < least) | ~allowed[:, i, None]] = -np.inf
            top = gains.max(axis=1)
            # Of cuts around bins without rows, the first.
            at = (gains >= (top - ROUNDING * (1 + whole))[:, None]).argmax(axis=1)
            for k in np.flatnonzero(top > out[:, 0] + ROUNDING * (1 + whole)):
                out[k] = top[k], i, at[k], gl[k, at[k]], hl[k, at[k]]
    return [(o[0], int(o[1]), int(o[2]), *sums, o[3], o[4]) for o, sums in zip(out.tolist(), zip(g.tolist(), h.tolist()))]


def _allowed(nodes: list[int], used: list[int], n_features: int, settings: Settings, number: int) -> np.ndarray:
    """Which features each node may split: those of the tree, or for a number a draw per node as in MLlib."""
    out = np.zeros((len(nodes), n_features), bool)
    if settings.classes:
        out[:, used] = True
        return out
    take = min(n_features, max(1, math.ceil(settings.feature_share * n_features)))
    for k, node in enumerate(nodes):
        out[k, random.Random(f"{settings.seed} {number} {node}").sample(range(n_features), take)] = True
    return out


def _round(state: RDD, parts: int, starts: np.ndarray, settings: Settings, number: int) -> list[Tree]:
    """The trees of all classes of one round, grown level by level together."""
    n_features, rate = len(starts) - 1, settings.rate_of(number)
    trees = [Tree() for _ in range(settings.outputs)]
    draw = random.Random(settings.seed * 1_000_003 + number)
    take = max(1, int(settings.feature_share * n_features)) if settings.classes else n_features
    used = [sorted(draw.sample(range(n_features), take)) for _ in trees]
    sums = [{0: (0.0, 0.0)} for _ in trees]
    # Nodes to split, nodes to sum, and for each node left out its parent and sibling.
    frontier, wanted, rest = [[0] for _ in trees], [[0] for _ in trees], [{} for _ in trees]
    above: list[dict] = [{} for _ in trees]
    for _ in range(settings.depth):
        if not any(frontier):
            break
        packed = [tree.packed() for tree in trees]

        def level(blocks, packed=packed, wanted=wanted):
            return _sums(blocks, packed, wanted, starts, used, settings, number)

        keys = sum(-(-len(nodes) // NODES_PER_KEY) for nodes in wanted)
        known: list[dict] = [{} for _ in trees]
        for (c, first), total in _added(state.mapPartitions(level), parts, keys).items():
            known[c].update(zip(wanted[c][first : first + NODES_PER_KEY], total.swapaxes(0, 1)))
        following, lighter, other = ([[] for _ in trees] for _ in range(3))
        for c, (tree, nodes) in enumerate(zip(trees, frontier)):
            if not nodes:
                continue
            for node, (parent, sibling) in rest[c].items():
                known[c][node] = above[c][parent] - known[c][sibling]
            total = np.stack([known[c][node] for node in nodes], axis=1)
            for node, (gain, feature, at, g, h, gl, hl) in zip(nodes, _best(total, starts, _allowed(nodes, used[c], n_features, settings, number), settings)):
                sums[c][node] = (g, h)
                if feature < 0:
                    continue
                left, right = tree.split(node, feature, at, gain)
                sums[c][left], sums[c][right] = (gl, hl), (g - gl, h - hl)
                following[c] += [left, right]
                light, heavy = (left, right) if 2 * hl <= h else (right, left)
                lighter[c].append(light)
                other[c].append((heavy, (node, light)))
        frontier, wanted, rest, above = following, lighter, [dict(o) for o in other], known
    for c, tree in enumerate(trees):
        for node, (g, h) in sums[c].items():
            tree.cover[node] = float(h)
            tree.value[node] = -rate * float(g) / (float(h) + settings.penalty) if h + settings.penalty else 0.0
    return trees


@dataclass
class Ensemble:
    """Fitted trees by round and class, and the upper edges of the bins."""

    rounds: list[list[Tree]]
    edges: list[np.ndarray]
    losses: list[float] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        packed = [[tree.packed() for tree in trees] for trees in self.rounds]
        out = np.zeros((len(x), len(packed[0]) if packed else 0))
        for start in range(0, len(x), ROWS_PER_BLOCK):
            part = slice(start, start + ROWS_PER_BLOCK)
            bins = np.stack([np.searchsorted(e, x[part, i]) for i, e in enumerate(self.edges)]).astype(np.uint8)
            for trees in packed:
                for c, tree in enumerate(trees):
                    out[part, c] += tree.values_of(bins)
        return out

    def importances(self) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.edges))
        for tree in (t for trees in self.rounds for t in trees):
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[feature] += gain
        return total / total.sum() if total.sum() else total

    def rows(self, first: int = 0) -> list[tuple]:
        """Nodes from a round on, in the form of ``STORED``."""
        return [
            (first + r, c, n, t.left[n], t.right[n], t.feature[n],
             float(self.edges[t.feature[n]][t.bin[n]]) if t.feature[n] >= 0 else None, t.bin[n], t.cover[n], t.gain[n], t.value[n])
            for r, trees in enumerate(self.rounds[first:]) for c, t in enumerate(trees) for n in range(len(t.feature))
        ]

    @classmethod
    def of(cls, rows: list, edges: list[np.ndarray]) -> "Ensemble":
        rounds: list[list[Tree]] = []
        for r in sorted(rows, key=lambda r: (r["round"], r["class"], r["node"])):
            if r["round"] == len(rounds):
                rounds.append([])
            if r["class"] == len(rounds[-1]):
                rounds[-1].append(Tree(*([] for _ in range(7))))
            for name in ("feature", "bin", "left", "right", "cover", "gain", "value"):
                getattr(rounds[-1][-1], name).append(r[name])
        return cls(rounds, edges)


def _stored_rounds(spark: SparkSession, store: str, key: str) -> list:
    """Nodes that an earlier fit of the same data and settings left behind."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    return spark.read.schema(f"key string, {STORED}").parquet(store).filter(F.col("key") == key).collect()


def _whole(rows: list) -> list:
    """Rows of the rounds from the first on without a gap, each counted once."""
    by_round: dict = {}
    for r in rows:
        by_round.setdefault(r["round"], {})[(r["class"], r["node"])] = r
    out, number = [], 0
    while number in by_round:
        out += by_round[number].values()
        number += 1
    return out


def fit(rows: DataFrame, features: str, label: str, weight: str | None, settings: Settings, store: str | None = None) -> Ensemble:
    """Fit an ensemble to vectors with class numbers 0, 1, 2 ... (or numbers) and, if given, weights.

    Under ``store`` trees are written every ``STORED_ROUNDS`` rounds; a fit of the same data and settings finds
    them there and goes on. Rows are drawn by block and round, so a repeated fit gives the same trees
    as long as the stored blocks are the same. ``losses`` has the log-loss (or squared error) every ``LOSS_ROUNDS`` rounds.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    given = F.col(weight) if weight else F.lit(1.0)
    table = as_table(
        rows.select(
            vector_to_array(features).alias("x"), F.col(label).cast("double").alias("label"),
            given.cast("double").alias("weight"), F.monotonically_increasing_id().alias("__n"),
        ),
        "boosting-rows",
    )
    facts = table.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("x")).alias("width"),
        F.sum(F.xxhash64("x", "label", "weight").cast("decimal(38,0)")).alias("content"),
    ).first()
    if not facts["rows"]:
        raise ValueError("no rows to fit")
    edges = bin_edges(table, facts["width"], settings.max_bins)
    # A task per core where rows allow it, each with many blocks: starting tasks is what small levels cost.
    cores = max(1, min(spark.sparkContext.defaultParallelism, facts["rows"] // LEAST_ROWS))
    parts = cores * -(-facts["rows"] // (cores * ROWS_PER_TASK))
    named = json.dumps([vars(settings), facts["rows"], str(facts["content"])])
    key = hashlib.sha256(named.encode()).hexdigest()
    ensemble = Ensemble.of(_whole(_stored_rounds(spark, store, key)) if store else [], edges)
    blocks = _blocks(table, edges, settings, parts)
    done, kept = list(ensemble.rounds[: settings.rounds]), len(ensemble.rounds)
    ensemble.rounds = done
    state, before, saved = _advanced(blocks, done), None, None
    starts = np.cumsum([0, *(len(e) + 1 for e in edges)])
    first = len(done)
    for number in range(first, settings.rounds):
        if number > first:
            before, state = state, _advanced(state, done[-1:])
            if number % CHECKPOINT_ROUNDS == 0:
                state.checkpoint()
            if number % LOSS_ROUNDS == 0:
                ensemble.losses.append(state.map(lambda b: Block(*b).loss(settings.classes)).sum() / facts["rows"])
        done.append(_round(state, parts, starts, settings, number))
        if before is not None:
            before.unpersist()
        if state.isCheckpointed():
            # Nothing reads an older one any more.
            drop_checkpoint(spark, saved)
            saved = state
        if store and (len(done) % STORED_ROUNDS == 0 or len(done) == settings.rounds):
            new = spark.createDataFrame([(key, *r) for r in ensemble.rows(kept)], f"key string, {STORED}")
            new.coalesce(1).write.mode("append").parquet(store)
            kept = len(done)
    state.unpersist()
    drop_checkpoint(spark, saved)
    return ensemble
