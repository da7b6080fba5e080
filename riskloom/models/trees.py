"""CART trees grown level by level, all trees of an ensemble in the same Spark job.

Per level one pass over the kept training rows adds up (rows, weight, positive weight) by
(node, feature, value); Spark merges these sums, and window and aggregate operators pick the
best split of every node. The driver only holds nodes.

The search is exact whatever the number of values. Large tables cut every feature into ranges of
values, so that no task sorts a whole feature; where the cuts fall changes nothing.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import functions as F, types as T

from riskloom.functions.memory import release
from riskloom.models.base import BLOCKS, Model, TrainingTable, _pack, shares, unpacked
from riskloom.models.splits import MIN_GAIN, RUNS, best_of_runs, packed_run, value_cuts
from riskloom.operators.ranking import ROWS_PER_BUCKET
from riskloom.schemas import FEATURES, LABEL

PURE = 1e-6
_CHUNK = 100_000
CODED = T.StructType([*BLOCKS, T.StructField("levels", T.BinaryType())])
_RUN_KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.StringType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("probability", T.DoubleType()), T.StructField("samples", T.LongType()),
])

@dataclass
class Nodes:
    """Nodes of several trees. A leaf points at itself, so walking on is harmless."""

    tree: list = field(default_factory=list)
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    probability: list = field(default_factory=list)
    samples: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    roots: list = field(default_factory=list)

    def add(self, tree, depth, samples=0, wgt=0.0, pos=0.0):
        at = len(self.tree)
        if depth == 0:
            self.roots.append(at)
        self.tree.append(tree)
        self.depth.append(depth)
        self.feature.append(-1)
        self.threshold.append(float("inf"))
        self.left.append(at)
        self.right.append(at)
        self.probability.append(0.0)
        self.samples.append(0)
        self.measure(at, samples, wgt, pos)
        return at

    def measure(self, at, samples, wgt, pos):
        self.samples[at] = int(samples)
        self.probability[at] = pos / wgt if wgt > 0 else 0.0

    def is_final(self, at, max_depth, min_split):
        p = self.probability[at]
        return (self.depth[at] >= max_depth or self.samples[at] < min_split
                or p <= PURE or p >= 1 - PURE)

    def split(self, at, feature, threshold, best):
        self.feature[at], self.threshold[at] = feature, threshold
        right = [max(best["node_" + k] - best["left_" + k], 0) for k in ("cnt", "wgt", "pos")]
        left = [best["left_" + k] for k in ("cnt", "wgt", "pos")]
        self.left[at] = self.add(self.tree[at], self.depth[at] + 1, *left)
        self.right[at] = self.add(self.tree[at], self.depth[at] + 1, *right)
        return [self.left[at], self.right[at]]

    def extend(self, other):
        """Append the trees of ``other``."""
        shift, trees = len(self.tree), len(self.roots)
        for name in ("feature", "threshold", "probability", "samples", "depth"):
            getattr(self, name).extend(getattr(other, name))
        self.tree.extend(t + trees for t in other.tree)
        self.left.extend(n + shift for n in other.left)
        self.right.extend(n + shift for n in other.right)
        self.roots.extend(n + shift for n in other.roots)

    def arrays(self):
        """Compact arrays for the tasks."""
        return WalkArrays(
            np.maximum(np.array(self.feature, dtype=np.int32), 0), np.array(self.threshold),
            np.array(self.left, dtype=np.int32), np.array(self.right, dtype=np.int32),
            np.array(self.probability), np.array(self.roots, dtype=np.int32),
            max(self.depth, default=0))

    def table(self, spark, names):
        """The node table as a DataFrame."""
        rows = [
            (self.tree[i], i, names[self.feature[i]] if self.feature[i] >= 0 else None,
             self.threshold[i] if self.feature[i] >= 0 else None,
             self.left[i] if self.feature[i] >= 0 else None,
             self.right[i] if self.feature[i] >= 0 else None,
             self.probability[i], self.samples[i])
            for i in range(len(self.tree))
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def split_counts(self, width):
        used = [f for f in self.feature if f >= 0]
        return np.bincount(used, minlength=width).tolist() if used else [0] * width


@dataclass
class WalkArrays:
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    probability: np.ndarray
    roots: np.ndarray
    depth: int

    def node_of(self, x, tree):
        """The node each row reaches in one tree: left while the value is at most the limit."""
        rows = np.arange(len(x))
        at = np.full(len(x), self.roots[tree], dtype=np.int32)
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.limit[at]
            at = np.where(below, self.left[at], self.right[at])
        return at

    def probabilities(self, x, tree):
        return self.probability[self.node_of(x, tree)]

    def boosted_score(self, x, base, rate):
        score = np.full(len(x), base)
        for tree in range(len(self.roots)):
            score += rate * (self.probabilities(x, tree) - 0.5) * 2.0
        return score


class TreeModel(Model):
    """Models whose probability comes from walking nodes: one vectorized Arrow UDF."""

    nodes: Nodes

    def combine(self, walk, x):
        raise NotImplementedError

    def probability(self):
        walk, combine = self.nodes.arrays(), self.combine

        @F.arrow_udf(T.DoubleType())
        def predict(*columns: pa.Array) -> pa.Array:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
            return pa.array(combine(walk, x))

        return predict(*[F.col(n).cast("double") for n in self.features])

    def node_table(self, spark):
        return self.nodes.table(spark, self.features)


@dataclass
class DecisionTreeModel(TreeModel):
    nodes: Nodes
    features: list
    name: str = "Decision Tree"

    def combine(self, walk, x):
        return walk.probabilities(x, 0)

    def importances(self):
        return shares(self.nodes.split_counts(len(self.features)))


# --- row weights: what one task needs to weigh its rows ---------------------------------------

@dataclass
class ClassWeights:
    positive: float = 1.0
    negative: float = 1.0

    def __call__(self, x, y):
        return np.where(y == 1, self.positive, self.negative)


@dataclass
class ResidualWeights:
    """Distance between label and the probability of the trees so far, at least ``floor``."""

    walk: WalkArrays
    base: float
    rate: float
    floor: float = 0.01

    def __call__(self, x, y):
        score = self.walk.boosted_score(x, self.base, self.rate)
        return np.maximum(np.abs(y - 1.0 / (1.0 + np.exp(-score))), self.floor)


class ValueTable(TrainingTable):
    """Training rows kept in chunks for repeated level passes, each value as its rank among the chunk's
    values of the feature: these are sorted once and not in every pass.

    ``draws``: optional array column over ``id``, how often each tree draws the row.
    """

    def __init__(self, df, names=FEATURES, label=LABEL, key="customer_id", draws=None,
                 rows_per_bucket=ROWS_PER_BUCKET):
        super().__init__(df, names, label, key)
        small = self.counts["samples"] <= rows_per_bucket
        self.cuts = None if small else value_cuts(
            self.rows.select(F.posexplode("x").alias("feature", "value")), len(self.names), rows_per_bucket)
        rows = self.rows if draws is None else self.rows.withColumn("draws", draws)
        pack, width = _pack(np.asarray, len(self.names), draws is not None), len(self.names)
        self.blocks = rows.drop("id").mapInArrow(_coded(pack, width), CODED).persist(StorageLevel.MEMORY_AND_DISK)


def _ranked(x):
    """Per feature its ascending values, and the place of each row's value there: (levels, codes)."""
    codes = np.empty(x.shape[::-1], np.int32)
    levels = []
    for f in range(x.shape[1]):
        values, codes[f] = np.unique(x[:, f], return_inverse=True)
        levels.append(values)
    return levels, codes.T


def _coded(pack, width):
    """Task function: chunks of rows as rows of CODED."""
    def run(batches):
        for x, y, draws in unpacked(pack(batches), np.float64, width, _CHUNK):
            levels, codes = _ranked(x)
            sizes = np.array([len(v) for v in levels], np.float64)
            values = (y, codes.T, draws, np.concatenate([sizes, *levels]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if v is None else v.tobytes()], pa.binary()) for v in values], CODED.fieldNames())
        release()

    return run


def _chunks(batches, width):
    """(values, levels, codes, labels, draws) of every chunk of rows, from rows of CODED or BLOCKS."""
    for batch in batches:
        if "levels" not in batch.schema.names:
            for x, y, draws in unpacked([batch], np.float64, width, _CHUNK):
                yield x, *_ranked(x), y, draws
            continue
        for i in range(batch.num_rows):
            y, codes, draws, stored = (batch.column(n)[i] for n in CODED.fieldNames())
            y = np.frombuffer(y.as_buffer(), np.uint8)
            codes = np.frombuffer(codes.as_buffer(), np.int32).reshape(width, -1).T
            draws = np.frombuffer(draws.as_buffer(), np.uint8).reshape(len(y), -1) if draws.is_valid else None
            stored = np.frombuffer(stored.as_buffer())
            levels = np.split(stored[width:], np.cumsum(stored[:width].astype(np.int64))[:-1])
            x = np.empty(codes.shape)
            for f, values in enumerate(levels):
                x[:, f] = values[codes[:, f]]
            yield x, levels, codes, y, draws


def _sum_by_key(keys, columns, size):
    """Distinct keys with the sum of each column."""
    if size <= 16 * len(keys):
        hits = np.bincount(keys, minlength=size)
        found = np.flatnonzero(hits)
        return found, [np.bincount(keys, c, size)[found] for c in columns]
    found, inverse = np.unique(keys, return_inverse=True)
    return found, [np.bincount(inverse, c, len(found)) for c in columns]


def _level_pass(walk, tree_of_slot, by_node, subsets, cuts, width, weigh):
    """Task function: runs of sums by value, per feature position of the nodes that have a slot.

    Within a chunk of rows values are replaced by their rank among the chunk's own values.
    """
    trees = sorted(set(tree_of_slot))

    def run(batches):
        for x, levels, codes, y, draws in _chunks(batches, width):
            slots = _Slots(tree_of_slot, by_node, subsets, [len(v) for v in levels])
            weight = weigh(x, y)
            for t in trees:
                slot = slots.by_node[walk.node_of(x, t)]
                times = np.ones(len(y)) if draws is None else draws[:, t].astype(float)
                rows = np.flatnonzero((slot >= 0) & (times > 0))
                if not len(rows):
                    continue
                n, w = times[rows], times[rows] * weight[rows]
                columns = [n, w, w * y[rows]]
                for position, feature in enumerate(subsets[t]):
                    keys = slots.start[slot[rows], position] + codes[rows, feature]
                    low, high = slots.span(t, position)
                    hit, total = _sum_by_key(keys - low, columns, high - low)
                    # Sent feature by feature: all trees' runs of a chunk are many times its rows.
                    found = list(slots.runs(
                        t, position, hit + low, total, levels[feature], cuts and cuts[feature]))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, type=k) for c, k in zip(zip(*found), _RUN_KINDS)], RUNS.fieldNames())
        release()

    return run


class _Slots:
    """Dense numbering of (open node, feature position, code), grouped by tree and position."""

    def __init__(self, tree_of_slot, by_node, subsets, sizes):
        self.tree_of_slot, self.by_node = tree_of_slot, by_node
        positions = max(len(s) for s in subsets)
        self.start = np.full((len(tree_of_slot), positions), -1, dtype=np.int64)
        self._spans, at = {}, 0
        for t in sorted(set(self.tree_of_slot)):
            mine = [s for s, owner in enumerate(self.tree_of_slot) if owner == t]
            for position, feature in enumerate(subsets[t]):
                low = at
                for s in mine:
                    self.start[s, position] = at
                    at += sizes[feature]
                self._spans[(t, position)] = (low, at)

    def span(self, tree, position):
        return self._spans[(tree, position)]

    def runs(self, tree, position, keys, sums, levels, cuts):
        """Rows of RUNS from the ascending ``keys`` of a tree's feature and the sums at them."""
        mine = [s for s, owner in enumerate(self.tree_of_slot) if owner == tree]
        starts = self.start[mine, position]
        edges = np.append(np.searchsorted(keys, starts), len(keys))
        for slot, start, a, b in zip(mine, starts, edges[:-1], edges[1:]):
            if a == b:
                continue
            values = levels[keys[a:b] - start]
            bucket = np.searchsorted(cuts, values) if cuts else np.zeros(b - a, np.int64)
            parts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for c, d in zip(parts[:-1], parts[1:]):
                yield slot, position, int(bucket[c]), packed_run(
                    values[c:d], np.rint(sums[0][a + c:a + d]), sums[1][a + c:a + d], sums[2][a + c:a + d])


def fit_nodes(table, trees, max_depth, min_split, subsets, weigh):
    """Grow ``trees`` trees at once; ``subsets`` gives each one its features in trying order."""
    nodes = Nodes()
    for t in range(trees):
        nodes.add(t, 0)
    open_nodes = list(nodes.roots)
    while open_nodes:
        by_node = np.full(len(nodes.tree), -1, dtype=np.int64)
        by_node[open_nodes] = np.arange(len(open_nodes))
        level = _level_pass(nodes.arrays(), [nodes.tree[n] for n in open_nodes], by_node, subsets,
                            table.cuts, len(table.names), weigh)
        partials = table.blocks.mapInArrow(level, RUNS)
        best, most = {}, trees * max(len(s) for s in subsets) * table.counts["samples"]
        for r in best_of_runs(partials, bucketed=bool(table.cuts), values=most):  # one row per open node and feature
            kept = best.get(r["slot"])
            if kept is None or (r["gain"], -r["feature"]) > (kept["gain"], -kept["feature"]):
                best[r["slot"]] = r
        opened = []
        for slot, at in enumerate(open_nodes):
            found = best.get(slot)
            if found is None:
                continue
            nodes.measure(at, found["node_cnt"], found["node_wgt"], found["node_pos"])
            if nodes.is_final(at, max_depth, min_split) or found["gain"] <= MIN_GAIN:
                continue
            feature = subsets[nodes.tree[at]][found["feature"]]
            children = nodes.split(at, feature, float(found["value"]), found)
            opened += [c for c in children if not nodes.is_final(c, max_depth, min_split)]
        open_nodes = opened
    return nodes


def fit_tree(df, max_depth=7, min_split=10, weight=None, names=FEATURES, label=LABEL,
             rows_per_bucket=ROWS_PER_BUCKET):
    """A single tree on all features; ``weight`` is an optional :class:`ClassWeights`."""
    with ValueTable(df, names, label, rows_per_bucket=rows_per_bucket) as table:
        nodes = fit_nodes(table, 1, max_depth, min_split, [list(range(len(names)))], weight or ClassWeights())
    return DecisionTreeModel(nodes, list(names))
