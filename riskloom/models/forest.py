"""Random forest: one feature subset per tree, row draws with replacement, class weights.

Draws are Poisson(1) counts from an md5 of (seed, tree, row): each row decides on its own, so no
task needs the row count or another task's rows. They replace the multinomial draw.
"""

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from riskloom.models.base import shares
from riskloom.models.trees import ClassWeights, Nodes, TreeModel, ValueTable, fit_nodes
from riskloom.schemas import FEATURES, LABEL

TREES, DEPTH, MIN_SPLIT = 25, 7, 10


def _poisson_steps():
    """Distribution function of Poisson(1) at 0, 1, ... until what is left is below 2 ** -53, beyond
    the grain of the uniform numbers."""
    steps, k = [], 0
    while not steps or 1.0 - steps[-1] >= 2.0**-53:
        steps.append(math.fsum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1)))
        k += 1
    return steps


def _poisson(u):
    """Poisson(1) count whose distribution function first exceeds ``u``."""
    steps = _poisson_steps()
    result = F.when(u < steps[0], 0)
    for k, total in enumerate(steps[1:-1], 1):
        result = result.when(u < total, k)
    return result.otherwise(len(steps) - 1)


def draw_counts(key, trees, seed):
    """Array with the number of times each tree draws the row.

    The uniform number of (seed, tree, row) is the first 52 bits of an md5, the same everywhere.
    """
    def bits(t):
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), t.cast("string"), key.cast("string")))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")

    uniform = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: bits(t) * F.lit(2.0**-52))
    return F.transform(uniform, _poisson)


def bootstrap_weights(df, trees=TREES, seed=42, key="customer_id"):
    """(key, tree, draws) for every row a tree draws at least once."""
    return df.select(key, F.posexplode(draw_counts(F.col(key).cast("bigint"), trees, seed)).alias("tree", "draws")).where(
        F.col("draws") > 0)


def subset_size(width):
    """``round(sqrt(width))`` features, at least 2."""
    return min(max(math.floor(math.sqrt(width) + 0.5), 2), width)


def feature_subsets(width, trees=TREES, seed=42):
    """Per tree its features in the order they are tried: those with the least md5 of (seed, tree, feature)."""
    def place(tree, feature):
        return hashlib.md5(f"{seed}:feature:{tree}:{feature}".encode()).hexdigest()

    return [sorted(range(width), key=lambda f: place(t, f))[:subset_size(width)] for t in range(trees)]


def drawn_features(df, trees=TREES, seed=42, names=FEATURES, key="customer_id"):
    """Per tree and feature of its subset: position, number of drawn rows, mean over these rows.

    Every row adds its values once per tree that draws it; sums are formed per task first.
    """
    subsets = feature_subsets(len(names), trees, seed)
    tried = F.array(*[F.array(*[F.struct(F.lit(p).alias("position"), F.lit(names[f]).alias("feature"), F.col(
        names[f]).cast("double").alias("value")) for p, f in enumerate(s)]) for s in subsets])
    per_tree = df.select(F.posexplode(F.arrays_zip(
        draw_counts(F.col(key), trees, seed).alias("draws"), tried.alias("tried"))).alias("tree", "drawn"))
    rows = per_tree.where("drawn.draws > 0").select("tree", "drawn.draws", F.inline("drawn.tried"))
    return rows.groupBy("tree", "position", "feature").agg(
        F.sum("draws").cast("long").alias("draws"),
        (F.sum(F.col("draws") * F.col("value")) / F.sum("draws")).alias("mean"))


@dataclass
class ForestModel(TreeModel):
    nodes: Nodes
    features: list
    name: str = "Random Forest"

    def combine(self, walk, x):
        if not len(walk.roots):
            return np.zeros(len(x))
        return sum(walk.probabilities(x, t) for t in range(len(walk.roots))) / len(walk.roots)

    def importances(self):
        """Share of the splits that use the feature."""
        return shares(self.nodes.split_counts(len(self.features)))


def fit_random_forest(df, trees=TREES, depth=DEPTH, min_split=MIN_SPLIT, seed=42, names=FEATURES,
                      label=LABEL, key="customer_id"):
    draws = draw_counts(F.col("id"), trees, seed)
    with ValueTable(df, names, label, key, draws) as table:
        weights = ClassWeights(table.counts["w_pos"], table.counts["w_neg"])
        subsets = feature_subsets(len(names), trees, seed)
        nodes = fit_nodes(table, trees, depth, min_split, subsets, weights)
    return ForestModel(nodes, list(names))
