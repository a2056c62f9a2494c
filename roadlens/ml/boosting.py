"""Gradient-boosted trees for two classes, grown as Spark's ``GBTClassifier``
grows them and returned as its model, on rows that take 17 bytes.

A row is its features' bin numbers (two of up to 32 bins in 16 bits), its label
and its margin so far, in blocks of numpy arrays in a persisted RDD. One pass
per level adds up counts and residuals by node, feature and bin; a tree's first
pass also adds the tree before to the margins. Residuals are rounded to 2^-32,
so that a sum is exact and doesn't depend on partitions or order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from roadlens.session import ship_package

BITS = 5
BINS = 1 << BITS
#: Rows per block: its sums of residuals stay below 2^53.
BLOCK = 1 << 16
#: Residuals (at most 4) are whole numbers of this unit.
UNIT = 2.0**-32
#: Trees after which the margins are made from the binned rows again, which ends the lineage.
REBUILD = 50
#: Candidate splits come from so many rows, as Spark takes them.
SPLIT_ROWS = 10_000
EPSILON = np.finfo(float).eps
#: Rows that one task passes over at most, so that blocks lie in a whole number of rounds.
TASK_ROWS = 1 << 22
#: Partial sums of more partitions are added up in tasks first.
DIRECT_PARTS = 64


# ---------------------------------------------------------------------------
# Candidate splits and bins
# ---------------------------------------------------------------------------


def split_points(values: np.ndarray, expected: float, n_splits: int) -> np.ndarray:
    """Thresholds between distinct values: all, or the nearest to equal shares of
    ``expected`` rows. Rows that are expected but not there count as zeros, and
    so do zeros."""
    distinct, counts = np.unique(values[values != 0.0], return_counts=True)
    counts = counts.astype(float)
    if not len(distinct):
        return np.empty(0)
    there = int(counts.sum())
    if expected - there > EPSILON * there * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, expected - there)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= n_splits:
        return middle
    stride, found = expected / (n_splits + 1), []
    target, so_far = stride, counts[0]
    for i in range(1, len(distinct)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            found.append(middle[i - 1])
            target += stride
    return np.array(found)


def find_splits(vectors, rows: int, seed: int, max_bins: int) -> list[np.ndarray]:
    """Spark's candidate splits per feature, from the rows that Spark draws."""
    fraction = min(1.0, max(max_bins * max_bins, SPLIT_ROWS) / rows)
    if fraction < 1:
        spark, jvm = vectors.sparkSession, vectors.sparkSession._jvm
        drawn = vectors._jdf.javaRDD().sample(False, fraction, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        vectors = type(vectors)(spark._jsparkSession.createDataFrame(drawn, vectors._jdf.schema()), spark)
    values = np.array([r[0].toArray() for r in vectors.collect()])
    return [split_points(values[:, j], fraction * rows, min(max_bins, rows) - 1) for j in range(values.shape[1])]


def _binned(splits: list[np.ndarray]):
    """Arrow batches of (features, label) to blocks of bin pairs and labels of -1 and 1."""
    pairs = -(-len(splits) // 2)

    def block(x, y):
        codes = np.zeros((pairs, len(y)), dtype=np.uint16)
        for j, points in enumerate(splits):
            codes[j // 2] |= np.searchsorted(points, x[:, j]).astype(np.uint16) << (BITS * (1 - j % 2))
        return {"rows": [len(y)], "codes": [codes.tobytes()], "labels": [(2 * y - 1).astype(np.int8).tobytes()]}

    def run(batches):
        held, n = [], 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(splits))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("Labels must be 0 or 1")
            if not np.isfinite(x).all():
                raise ValueError("Features must not be NaN or infinite")
            while n + len(y) >= BLOCK:
                held.append((x[:BLOCK - n], y[:BLOCK - n]))
                x, y = x[BLOCK - n:], y[BLOCK - n:]
                yield pa.RecordBatch.from_pydict(block(*(np.concatenate(p) for p in zip(*held))), schema=_BLOCK_ARROW)
                held, n = [], 0
            held.append((x, y))
            n += len(y)
        if n:
            yield pa.RecordBatch.from_pydict(block(*(np.concatenate(p) for p in zip(*held))), schema=_BLOCK_ARROW)

    return run


_BLOCK_ARROW = pa.schema([("rows", pa.int64()), ("codes", pa.binary()), ("labels", pa.binary())])
_BLOCK_SQL = "rows long, codes binary, labels binary"


def _unpack(row):
    return (np.frombuffer(row.codes, dtype=np.uint16).reshape(-1, row.rows).copy(),
            np.frombuffer(row.labels, dtype=np.int8).copy(), np.zeros(row.rows))


# ---------------------------------------------------------------------------
# Trees. Nodes are numbered as in a heap: root 1, children 2i and 2i + 1.
# ---------------------------------------------------------------------------


@dataclass
class Node:
    n: int
    total: float
    squares: float
    gain: float = -1.0
    feature: int = -1
    bin: int = -1

    @property
    def mean(self) -> float:
        return self.total / self.n

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.n) / self.n


@dataclass
class Tree:
    depth: int
    nodes: dict[int, Node] = field(default_factory=dict)

    def rights(self, level: int) -> list[tuple[int, int, int]]:
        """(place in the level, feature, bin) of the level's splits."""
        first = 1 << level
        return [(i - first, n.feature, n.bin) for i, n in sorted(self.nodes.items())
                if first <= i < 2 * first and n.feature >= 0]

    def leaves(self) -> np.ndarray:
        """Predictions by place at the deepest level; rows in a leaf above keep left."""
        out = np.zeros(1 << self.depth)
        for place in range(len(out)):
            i = len(out) + place
            while i not in self.nodes:
                i >>= 1
            out[place] = self.nodes[i].mean
        return out


def _places(codes: np.ndarray, splits: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """The rows' places in the level below the given levels' splits."""
    place = np.zeros(codes.shape[1], dtype=np.uint8)
    bins: dict[int, np.ndarray] = {}
    for level in splits:
        right = np.zeros(len(place), dtype=np.uint8)
        for at, j, b in level:
            if j not in bins:
                bins[j] = (codes[j // 2] >> (BITS * (1 - j % 2)) & (BINS - 1)).astype(np.uint8)
            np.bitwise_or(right, (bins[j] > b) & (place == at), out=right)
        place = place * np.uint8(2) + right
    return place


def _with_tree(block, rights, leaves, weight):
    codes, labels, margin = block
    return codes, labels, margin + leaves[_places(codes, rights)] * weight


def _adding(trees):
    """A block's margins with the trees (their splits, leaves and weight) added."""
    def run(block):
        for tree in trees:
            block = _with_tree(block, *tree)
        return block

    return run


def _sums(first: bool, splits, pairs: int, all_squares: bool):
    """Per partition: counts, residuals (high and low halves) and their squares by
    feature, node and bin. Squares come for the first features only, whose sums
    are the nodes', unless ``all_squares``."""
    nodes = 1 << len(splits)
    cells = nodes * BINS * BINS
    shape = (nodes, BINS, BINS)

    def run(blocks):
        counts, totals = np.zeros((pairs, cells), dtype=np.int64), np.zeros((pairs, cells), dtype=np.int64)
        squares = np.zeros((pairs, cells))
        for codes, labels, margin in blocks:
            y = labels.astype(float)
            if first:
                r = y
            else:
                with np.errstate(over="ignore"):
                    r = 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
            r = np.rint(r / UNIT)
            r2 = (r * UNIT) ** 2
            base = _places(codes, splits).astype(np.int64) * (BINS * BINS)
            at = np.empty_like(base)
            for p in range(pairs):
                np.add(base, codes[p], out=at)
                counts[p] += np.bincount(at, minlength=cells)
                totals[p] += np.bincount(at, r, cells).astype(np.int64)
                if all_squares or not p:
                    squares[p] += np.bincount(at, r2, cells)

        def by_feature(sums):
            return np.stack([s.reshape(shape).sum(axis) for s in sums for axis in (2, 1)])

        totals = by_feature(totals)
        yield by_feature(counts), totals >> 32, totals & 0xFFFFFFFF, by_feature(squares)

    return run


def _add(a, b):
    return tuple(x + y for x, y in zip(a, b))


def _grow(tree: Tree, level: int, sums, candidates: list[int]) -> None:
    """Splits the level's nodes at the largest gain."""
    counts, high, low, squares = sums
    totals = high + low * UNIT  # high: whole units of 2^32 * UNIT = 1
    left_n, left_t, left_s = (np.cumsum(s, axis=2)[:, :, :-1] for s in (counts, totals, squares))
    usable = np.arange(BINS - 1)[None, :] < np.array(candidates)[:, None]
    for place in range(1 << level):
        i = (1 << level) + place
        if level and (i >> 1 not in tree.nodes or tree.nodes[i >> 1].feature < 0):
            continue
        node = tree.nodes[i] = Node(int(counts[0, place].sum()), _exact(high[0, place], low[0, place]), float(squares[0, place].sum()))
        if level and abs(node.impurity) < EPSILON:
            continue
        nl = left_n[:len(candidates), place].astype(float)
        nr = node.n - nl
        with np.errstate(divide="ignore", invalid="ignore"):
            means = left_t[:len(candidates), place] / nl - (node.total - left_t[:len(candidates), place]) / nr
            gain = np.where(usable & (nl >= 1) & (nr >= 1), nl * nr / float(node.n) ** 2 * means**2, -1.0)
        j, b = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[j, b] <= 0:
            continue
        node.gain, node.feature, node.bin = float(gain[j, b]), int(j), int(b)
        if level + 1 == tree.depth:
            n, t, s = int(left_n[j, place, b]), _exact(high[j, place, :b + 1], low[j, place, :b + 1]), float(left_s[j, place, b])
            tree.nodes[2 * i] = Node(n, t, s)
            tree.nodes[2 * i + 1] = Node(node.n - n, _exact(high[j, place, b + 1:], low[j, place, b + 1:]),
                                         float(squares[j, place, b + 1:].sum()))


def _exact(high: np.ndarray, low: np.ndarray) -> float:
    return ((int(high.sum()) << 32) + int(low.sum())) * UNIT


class BinnedGBTClassifier(GBTClassifier):
    """``GBTClassifier`` whose model is fitted on binned rows. Parameters that only
    Spark's own fit knows are left to it."""

    OWN = {"labelCol", "featuresCol", "maxIter", "stepSize", "maxDepth", "seed"}

    def _fit(self, dataset):
        if self.getMaxDepth() > 7 or any(self.isSet(p) and p.name not in self.OWN for p in self.params):
            return super()._fit(dataset)
        ship_package(dataset.sparkSession)
        vectors = dataset.select(F.col(self.getFeaturesCol()))
        rows = vectors.count()
        if not rows:
            raise ValueError("No rows to fit to")
        splits = find_splits(vectors, rows, self.getSeed(), self.getMaxBins())
        trees, weights = self._boost(dataset, rows, splits)
        return self._copyValues(GBTClassificationModel(self._jvm_model(dataset.sparkSession, trees, weights, splits)))

    def _boost(self, dataset, rows, splits):
        pairs, depth = -(-len(splits) // 2), self.getMaxDepth()
        candidates = [len(s) for s in splits]
        frame = dataset.select(vector_to_array(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("double"))
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        parts = min(cores * -(-rows // (cores * TASK_ROWS)), -(-rows // BLOCK))
        blocks = frame.mapInArrow(_binned(splits), _BLOCK_SQL).repartition(parts)
        binned = blocks.rdd.map(_unpack).persist(StorageLevel.MEMORY_AND_DISK)
        weights = [1.0] + [self.getStepSize()] * (self.getMaxIter() - 1)
        trees: list[Tree] = []
        state, before, added = binned, None, []
        try:
            for weight in weights:
                tree = Tree(depth)
                for level in range(depth):
                    above = [tree.rights(k) for k in range(level)]
                    if level and not above[-1]:
                        break
                    partial = state.mapPartitions(_sums(not trees, above, pairs, level + 1 == depth))
                    sums = partial.reduce(_add) if parts <= DIRECT_PARTS else partial.treeReduce(_add)
                    if before is not None and before is not binned:
                        before.unpersist()
                    before = None
                    _grow(tree, level, sums, candidates)
                trees.append(tree)
                added.append(([tree.rights(k) for k in range(depth)], tree.leaves(), weight))
                before = state
                added_now = binned.map(_adding(list(added))) if len(trees) % REBUILD == 0 else state.map(_adding(added[-1:]))
                state = added_now.persist(StorageLevel.MEMORY_AND_DISK)
        finally:
            for held in (state, before, binned):
                if held is not None:
                    held.unpersist()
        return trees, weights

    def _jvm_model(self, spark, trees, weights, splits):
        jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
        tree_package, parse = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.linalg.Vectors.parse
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        regression = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel

        def made(tree, i):
            node = tree.nodes[i]
            stats = calculator(parse(f"[{float(node.n)!r},{node.total!r},{node.squares!r}]").toArray(), node.n)
            if node.feature < 0:
                return tree_package.LeafNode(node.mean, node.impurity, stats)
            split = tree_package.ContinuousSplit(node.feature, float(splits[node.feature][node.bin]))
            return tree_package.InternalNode(node.mean, node.impurity, node.gain, made(tree, 2 * i), made(tree, 2 * i + 1), split, stats)

        models, as_doubles = array(regression, len(trees)), array(jvm.double, len(trees))
        for i, (tree, weight) in enumerate(zip(trees, weights)):
            models[i], as_doubles[i] = regression(f"{self.uid}_{i}", made(tree, 1), len(splits)), weight
        return jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, models, as_doubles, len(splits), 2)
