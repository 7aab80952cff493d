"""Exact Shapley values of tree models in polynomial time.

A tree is a table of nodes. Each leaf is a box: for every feature on its path an interval that
a row must lie in. Leaves are explained one by one and added up, so the work grows with leaves x depth
and not with the number of feature subsets:

* Against a **background**, a leaf counts for a row and a background row if each of its intervals holds one of them. With
  ``a`` intervals that only the row is in and ``b`` that only the background row is in, every feature of the first
  kind gets ``(a-1)! b! / (a+b)!`` of the leaf's value, and every one of the second loses ``a! (b-1)! / (a+b)!``.
  Both depend only on which intervals hold the row and which the background row. So the background is counted by such
  patterns once per leaf, and a row costs the same with any number of background rows.
* Without one, an absent feature follows both branches in proportion to their training rows. The weight of all subsets
  of ``s`` of the other features is the integral of ``q^s (1-q)^(m-1-s)``, so the sum over subsets becomes a product of
  one factor per feature, integrated exactly by Gauss-Legendre nodes.

Distinct rows stay where they are; leaves travel to them in slices of bounded size.
"""

from collections.abc import Iterator
from math import factorial
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table, shared_folder, spread
from claimloom.operators.candidates import BoostedRegressionModel
from claimloom.operators.forest import ForestModel

NODES = "tree int, node int, left int, right int, feature int, threshold double, cover double, values array<double>"
LEAVES = "tree int, leaf int, features array<int>, low array<double>, high array<double>, absent array<double>, values array<double>"

# Leaves that are sent to all tasks at a time.
SLICE_LEAVES = 20_000
# Leaves and rows that are handled together: the working arrays have rows x leaves x depth numbers.
LEAF_BLOCK, ROW_BLOCK = 128, 512
# Rows times leaves per task, by background rows and by patterns.
WORK_PER_TASK, PATTERN_WORK = 2_000_000, 50_000_000
# Features of a path up to which leaves are weighed by patterns: there are 2^features.
PATTERN_FEATURES = 8


def is_tree_model(model: Model) -> bool:
    """Whether :func:`model_nodes` knows the model and its trees add up to its output."""
    return isinstance(model, (DecisionTreeClassificationModel, RandomForestClassificationModel, DecisionTreeRegressionModel,
                              RandomForestRegressionModel, GBTRegressionModel, ForestModel, BoostedRegressionModel))


def model_nodes(model: Model, classes: int) -> DataFrame:
    """The nodes of a fitted forest, MLlib tree, MLlib forest or boosted regressor (MLlib's or this package's).

    Leaf values are class shares or the predicted number, scaled so that the sums over all trees
    are the model's output: probabilities of a classifier, the number of a regressor. A node's ``cover`` is the weight
    of the training rows that reached it.
    """
    if isinstance(model, ForestModel):
        shares = F.transform("value", lambda v: v / model.getNumTrees)
        padded = F.array(*[F.coalesce(F.get(shares, F.lit(c)), F.lit(0.0)) for c in range(classes)])
        return model.nodes().select("tree", "node", "left", "right", "feature", "threshold", "cover", padded.alias("values"))
    if isinstance(model, BoostedRegressionModel):
        return model.nodes().select(
            F.col("round").alias("tree"), "node", "left", "right", "feature", "threshold", "cover", F.array("value").alias("values")
        )
    spark = SparkSession.getActiveSession()
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/model-{uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        trees = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "scale").select("tree", "scale")
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(trees), "tree")
    else:
        saved = saved.withColumns({"tree": F.lit(0), "scale": F.lit(1.0)})
    stats = F.col("impurityStats")
    boosted = isinstance(model, GBTRegressionModel)
    shares = isinstance(model, (DecisionTreeClassificationModel, RandomForestClassificationModel))
    scale = F.col("scale") if boosted else F.col("scale") / getattr(model, "getNumTrees", 1)
    if shares:
        cover = F.aggregate(stats, F.lit(0.0), lambda a, v: a + v)
        values = F.array(*[F.coalesce(F.get(stats, F.lit(c)), F.lit(0.0)) / cover * scale for c in range(classes)])
    else:
        cover, values = stats[0], F.array(F.col("prediction") * scale)
    # A 0/1 feature, such as one level of a flag, is split by category: left are the rows with the listed one.
    first, categories = F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)), F.col("split.numCategories")
    if not saved.filter(categories > 2).isEmpty():
        raise ValueError("splits of features with more than two categories are no intervals")
    turned = (categories == 2) & (first == 1)
    return saved.select(
        "tree", F.col("id").alias("node"),
        F.when(turned, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(turned, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.when(categories == 2, F.lit(0.5)).otherwise(first).alias("threshold"),
        cover.alias("cover"), values.alias("values"),
    )


def _paths(group: pa.Table) -> pa.Table:
    """The leaves of one tree with their boxes."""
    node = {r["node"]: r for r in group.to_pylist()}
    children = {c for r in node.values() if r["left"] >= 0 for c in (r["left"], r["right"])}
    stack = [(n, {}) for n in node if n not in children]
    out = {name: [] for name in ("tree", "leaf", "features", "low", "high", "absent", "values")}
    while stack:
        at, box = stack.pop()
        row = node[at]
        if row["left"] < 0:
            for name, value in (
                ("tree", row["tree"]), ("leaf", at), ("features", list(box)), ("values", row["values"]),
                *((n, [b[i] for b in box.values()]) for i, n in enumerate(("low", "high", "absent"))),
            ):
                out[name].append(value)
            continue
        low, high, absent = box.get(row["feature"], (-np.inf, np.inf, 1.0))
        for child, interval in (
            (row["left"], (low, min(high, row["threshold"]))), (row["right"], (max(low, row["threshold"]), high))
        ):
            part = node[child]["cover"] / row["cover"] if row["cover"] else 0.0
            stack.append((child, {**box, row["feature"]: (*interval, absent * part)}))
    doubles = pa.list_(pa.float64())
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), doubles, doubles, doubles, doubles]
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def leaf_boxes(nodes: DataFrame) -> DataFrame:
    """One row per leaf: the features of its path, their intervals (low, high] and shares of training rows that
    follow the path where the feature is absent, and the leaf's values."""
    return nodes.groupBy("tree").applyInArrow(_paths, LEAVES)


class Boxes:
    """Leaves as arrays, padded with a feature that no row has."""

    def __init__(self, leaves: pa.Table, n_features: int):
        features = leaves["features"].to_pylist()
        depth = max(map(len, features), default=0) or 1
        self.n_features = n_features

        def padded(rows: list, filler: float, kind: type) -> np.ndarray:
            out = np.full((len(rows), depth), filler, kind)
            for i, row in enumerate(rows):
                out[i, : len(row)] = row
            return out

        self.features = padded(features, n_features, np.int64)
        self.low = padded(leaves["low"].to_pylist(), -np.inf, float)
        self.high = padded(leaves["high"].to_pylist(), np.inf, float)
        self.absent = padded(leaves["absent"].to_pylist(), 1.0, float)
        self.values = np.array(leaves["values"].to_pylist(), float)

    def __len__(self) -> int:
        return len(self.values)

    def part(self, start: int, size: int) -> "Boxes":
        out = Boxes.__new__(Boxes)
        out.n_features = self.n_features
        for name in ("features", "low", "high", "absent", "values"):
            setattr(out, name, getattr(self, name)[start : start + size])
        return out

    def inside(self, x: np.ndarray) -> np.ndarray:
        """Rows x leaves x path: whether the row lies in the interval. A missing number goes right at every split."""
        at = np.column_stack([x, np.zeros(len(x))])[:, self.features]
        return ~(at <= self.low) & ((at <= self.high) | (self.high == np.inf))

    def totals(self, shares: np.ndarray) -> np.ndarray:
        """Shares of rows x leaves x path times leaf values, added up by feature: rows x features x outputs."""
        outputs = self.values.shape[1]
        spots = np.zeros((*self.features.shape, self.n_features + 1, outputs))
        leaf, place = np.indices(self.features.shape)
        spots[leaf, place, self.features] = self.values[leaf]
        flat = shares.reshape(len(shares), -1) @ spots.reshape(self.features.size, -1)
        return flat.reshape(len(shares), self.n_features + 1, outputs)[:, : self.n_features]


def _weights(depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapley weights by the numbers of intervals that only the row, or only the background row, lies in."""
    gain, loss = np.zeros((2, depth + 1, depth + 1))
    for a in range(depth + 1):
        for b in range(depth + 1 - a):
            if a:
                gain[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                loss[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return gain, loss


def _pattern_weights(depth: int) -> np.ndarray:
    """Shapley weight of each feature of a path by the patterns of intervals that hold the background row, and the row."""
    gain, loss = _weights(depth)
    bits = (np.arange(2**depth)[:, None] >> np.arange(depth)) & 1 == 1
    theirs, present = bits[:, None], bits[None, :]
    alone, gone = present & ~theirs, theirs & ~present
    counts = alone.sum(axis=2), gone.sum(axis=2)
    reached = (present | theirs).all(axis=2)
    return alone * (reached * gain[counts])[:, :, None] - gone * (reached * loss[counts])[:, :, None]


def _codes(inside: np.ndarray) -> np.ndarray:
    """Which intervals hold a row, as a number."""
    out = np.zeros(inside.shape[:2], np.int64)
    for i in range(inside.shape[2]):
        out |= inside[:, :, i].astype(np.int64) << i
    return out


def against_patterns(boxes: Boxes, background: list[tuple[list, float]], weights: np.ndarray):
    """The values of rows as a function of blocks of them, and the mean output of the background."""
    theirs = _codes(boxes.inside(np.array([b for b, _ in background], float)))
    shares, leaf = np.array([share for _, share in background]), np.arange(len(boxes))
    counts = np.zeros((len(boxes), len(weights)))
    np.add.at(counts, (np.broadcast_to(leaf, theirs.shape), theirs), shares[:, None])
    table = (counts @ weights.reshape(len(weights), -1)).reshape(len(boxes), *weights.shape[1:])
    return lambda x: boxes.totals(table[leaf, _codes(boxes.inside(x))]), counts[:, -1] @ boxes.values


def against_background(boxes: Boxes, x: np.ndarray, background: list[tuple[list, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Values of rows x features x outputs, and the mean output of the background."""
    gain, loss = _weights(boxes.features.shape[1])
    present = boxes.inside(x)
    others = boxes.inside(np.array([b for b, _ in background], float))
    shares, base = np.zeros(present.shape), np.zeros(boxes.values.shape[1])
    for (_, share), other in zip(background, others):
        base += share * boxes.values[other.all(axis=1)].sum(axis=0)
        alone, theirs = present & ~other, other & ~present
        counts = alone.sum(axis=2), theirs.sum(axis=2)
        reached = share * (present | other).all(axis=2)
        shares += alone * (reached * gain[counts])[:, :, None] - theirs * (reached * loss[counts])[:, :, None]
    return boxes.totals(shares), base


def by_cover(boxes: Boxes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of rows x features x outputs where absent features follow the training rows, and the mean output."""
    present = boxes.inside(x).astype(float)
    sums = np.zeros(present.shape)
    nodes, weights = np.polynomial.legendre.leggauss(boxes.features.shape[1] // 2 + 1)
    for q, weight in zip((nodes + 1) / 2, weights / 2):
        factors = boxes.absent * (1 - q) + present * q
        # A factor is zero only where no training row went and the row does not go either: the leaf counts for nothing.
        products = factors.prod(axis=2, keepdims=True)
        sums += weight * np.divide(products, factors, out=np.zeros_like(factors), where=factors > 0)
    return boxes.totals((present - boxes.absent) * sums), boxes.absent.prod(axis=1) @ boxes.values


def tree_values(
    nodes: DataFrame, vectors: DataFrame, n_features: int, outputs: int, background: list[tuple[list, float]] | None = None
) -> DataFrame:
    """Shapley values of every row of ``vectors`` (column ``__x``, array of doubles).

    ``nodes`` has the columns of :func:`model_nodes`: children are -1 in leaves, and a row goes left if its
    feature is at most the threshold. ``background`` lists vectors with their shares; without it absent
    features follow the training rows by ``cover``. Returns ``__x``, ``shap`` (features x outputs) and ``base``
    (outputs); they add up to the sum of the leaf values that the row reaches.
    """
    leaves = as_table(leaf_boxes(nodes).withColumn("slice", F.lit(0)), "leaves")
    count = leaves.count()
    slices = -(-count // SLICE_LEAVES)
    if slices > 1:
        dealt = F.pmod(F.xxhash64("tree", "leaf"), F.lit(2 * slices))
        leaves, slices = as_table(leaves.withColumn("slice", dealt), "leaf-slices"), 2 * slices
    # No split tells the vectors of a cell apart, so one of them is explained for all.
    cells = as_table(_with_cells(vectors.select("__x"), _thresholds(nodes, n_features)), "cells")
    explained = as_table(cells.groupBy("cell").agg(F.min("__x").alias("__x")), "vectors")
    patterns = bool(background) and (leaves.agg(F.max(F.size("features"))).first()[0] or 0) <= PATTERN_FEATURES
    work = explained.count() * count * (1 if patterns else max(1, len(background or ()) // 8))
    state = spread(explained.select("__x"), work, PATTERN_WORK if patterns else WORK_PER_TASK).withColumns(
        {"flat": F.array_repeat(F.lit(0.0), n_features * outputs), "base": F.array_repeat(F.lit(0.0), outputs)}
    )
    for number in range(slices):
        # Bounded: about SLICE_LEAVES leaves, dealt by hash.
        boxes = Boxes(leaves.filter(F.col("slice") == number).toArrow(), n_features)
        state = as_table(_add(state, boxes, background), "values")
    per_feature = F.transform(
        F.sequence(F.lit(0), F.lit(n_features - 1)), lambda i: F.slice("flat", i * outputs + 1, outputs)
    )
    found = state.select("__x", per_feature.alias("shap"), "base").join(explained, "__x").drop("__x")
    return cells.join(found, "cell").select("__x", "shap", "base")


def _thresholds(nodes: DataFrame, n_features: int) -> list[np.ndarray]:
    """The thresholds of each feature in order; fitted trees have at most a bin's number of them."""
    found = nodes.filter((F.col("left") >= 0) & F.col("threshold").isNotNull()).select("feature", "threshold").distinct().collect()
    return [np.array(sorted(r["threshold"] for r in found if r["feature"] == i), float) for i in range(n_features)]


def _with_cells(vectors: DataFrame, thresholds: list[np.ndarray]) -> DataFrame:
    """Add ``cell``: between which thresholds each number lies."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(thresholds))
            cells = np.column_stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(thresholds)])
            lists = pa.array(list(cells.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["__x", "cell"])

    return vectors.mapInArrow(place, "__x array<double>, cell array<int>")


def _add(state: DataFrame, boxes: Boxes, background: list | None) -> DataFrame:
    """Add a slice of leaves to the running values."""
    shared = state.sparkSession.sparkContext.broadcast(boxes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        depth = known.features.shape[1]
        weights = _pattern_weights(depth) if background and depth <= PATTERN_FEATURES else None
        for batch in batches:
            n = batch.num_rows
            x, flat, base = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) if n else np.empty((0, 1)) for i in range(3))
            for at in range(0, len(known), LEAF_BLOCK):
                part = known.part(at, LEAF_BLOCK)
                if weights is not None:
                    values, mean = against_patterns(part, background, weights)
                for start in range(0, n, ROW_BLOCK):
                    rows = slice(start, start + ROW_BLOCK)
                    if weights is not None:
                        found = values(x[rows])
                    else:
                        found, mean = against_background(part, x[rows], background) if background else by_cover(part, x[rows])
                    flat[rows] += found.reshape(len(found), -1)
                if n:
                    base += mean
            starts = [pa.array(np.arange(n + 1, dtype=np.int32) * v.shape[1] if n else [0], pa.int32()) for v in (flat, base)]
            lists = [pa.ListArray.from_arrays(o, pa.array(v.ravel(), pa.float64())) for o, v in zip(starts, (flat, base))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["__x", "flat", "base"])

    return state.mapInArrow(add, "__x array<double>, flat array<double>, base array<double>")
