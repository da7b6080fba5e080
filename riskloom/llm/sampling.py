"""Folds, bounded samples of labelled texts, and gradient steps."""

import numpy as np
from pyspark.sql import functions as F

#: The bounded sample leaves out longer texts.
LONGEST_TRAINING_TEXT = 100_000


def fold(doc_id, parts):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(docs, labels, label, rows, per_class):
    """(text, y, weight): at most ``per_class`` texts of each class among the label rows that the
    condition ``rows`` allows, drawn by the hash of the id.

    ``weight`` is how many label rows of its class a row stands for. An id labelled twice counts
    once, with the larger label; null ids and labels are left out, and so is a text that is null or
    longer than ``LONGEST_TRAINING_TEXT``; of the texts of a repeated id the least is taken. The
    sample has 2 x ``per_class`` ids at most, so it is broadcast.
    """
    known = labels.filter(rows & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(
        "doc_id").agg(F.max(label).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = None
    for y in (0, 1):
        n = counts.get(y, 0)
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).select(
            "doc_id", "y", F.lit(n / max(1, min(n, per_class))).alias("weight"))
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select("doc_id", "text").filter(F.length("text") <= LONGEST_TRAINING_TEXT).join(
        F.broadcast(drawn), "doc_id")
    return texts.groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("y").alias("y"), F.max("weight").alias("weight"))


def batches(draw, rows, size, steps):
    """(batch, part of the way done) for ``steps`` batches of shuffled passes over ``rows``."""
    queue = rows[:0]
    for step in range(steps if len(rows) else 0):
        if not len(queue):
            queue = draw.permutation(rows)
        yield queue[:size], step / steps
        queue = queue[size:]


class Adam:
    """Steps for a dict of arrays."""

    def __init__(self, weights, rate):
        self.weights, self.rate, self.steps = weights, rate, 0
        self.first = {n: np.zeros_like(w) for n, w in weights.items()}
        self.second = {n: np.zeros_like(w) for n, w in weights.items()}

    def step(self, grads, factor=1.0):
        self.steps += 1
        rate = self.rate * factor
        for name, g in grads.items():
            first, second = self.first[name], self.second[name]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            self.weights[name] -= (
                rate * (first / (1 - 0.9 ** self.steps))
                / (np.sqrt(second / (1 - 0.99 ** self.steps)) + 1e-8)).astype(np.float32)
