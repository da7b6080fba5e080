"""Logistic regression by full-batch gradient descent with a fixed schedule.

The result is the state after a fixed number of steps, not the optimum. Every step adds up one
partial gradient per task and is a job over the kept training table. Rows that one task can hold take
all steps in it, without a job for each. (A barrier stage whose tasks gather each other's sums does
the same for more tasks, but Spark lets a gather wait for a second: ten times a job here.)
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from riskloom.functions.probability import LOGIT_LIMIT
from riskloom.models.base import Model, TrainingTable, shares, unpacked
from riskloom.operators.aggregates import feature_moments
from riskloom.schemas import FEATURES, LABEL

LEARNING_RATE, EPOCHS, L2 = 0.05, 150, 0.001
DECAY = 0.01
MAX_PARTIALS = 1_000
#: Rows that one task may hold for all steps.
HELD_ROWS = 200_000


@dataclass
class LogisticModel(Model):
    weights: list
    bias: float
    means: list
    deviations: list
    features: list
    name: str = "Logistic Regression"

    def log_odds(self):
        z = F.lit(self.bias)
        for w, column in zip(self.weights, zscore(self.features, self.means, self.deviations)):
            z = z + F.lit(w) * column
        return z

    def importances(self):
        return shares([abs(w) for w in self.weights])


def zscore(names, means, deviations):
    """(x - mean) / deviation per feature, as columns; a vanishing deviation counts as 1."""
    return [
        (F.col(n) - F.lit(float(m))) / F.lit(float(s) if s > 1e-8 else 1.0)
        for n, m, s in zip(names, means, deviations)
    ]


def _standardize(means, deviations):
    return lambda x: (x - means) / deviations


def _partial_gradient(blocks, weights, bias, w_pos, w_neg):
    """Sum over the rows of the gradient by weight, the bias last."""
    width = len(weights)
    total = np.zeros(width + 1)
    for x, y in blocks:
        z = x @ weights + bias
        with np.errstate(over="ignore"):
            p = np.where(z >= LOGIT_LIMIT, 1.0, np.where(z <= -LOGIT_LIMIT, 0.0, 1.0 / (1.0 + np.exp(-z))))
        error = (p - y) * np.where(y == 1, w_pos, w_neg)
        total[:width] += error @ x
        total[width] += error.sum()
    return total


@dataclass
class _Steps:
    """The schedule; a state is the weights with the bias behind them."""

    rate: float
    epochs: int
    l2: float
    samples: int
    w_pos: float
    w_neg: float

    def partial(self, blocks, state):
        return _partial_gradient(blocks, state[:-1], state[-1], self.w_pos, self.w_neg)

    def step(self, state, partials, epoch):
        gradient = np.array(partials).sum(axis=0) / self.samples
        gradient[:-1] += self.l2 * state[:-1]
        return state - self.rate / (1.0 + DECAY * epoch) * gradient


def _row(values):
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], [f"g{j}" for j in range(len(values))])


def _blocks(batches, width):
    return ((x, y) for x, y, _ in unpacked(batches, np.float64, width))


def _in_one_task(rows, schema, steps, state):
    """All steps in the one task that holds the rows."""
    def run(batches):
        here, now = list(_blocks(batches, len(state) - 1)), state
        for epoch in range(steps.epochs):
            now = steps.step(now, [steps.partial(here, now)], epoch)
        yield _row(now)

    return np.array(rows.mapInArrow(run, schema).collect()[0])


def _job_by_job(rows, schema, steps, state, tasks):
    """A job per step over the kept rows."""
    merged = [F.sum(f.name).alias(f.name) for f in schema.fields]
    for epoch in range(steps.epochs):
        now = state

        def run(batches, now=now):
            yield _row(steps.partial(_blocks(batches, len(now) - 1), now))

        partials = rows.mapInArrow(run, schema)
        if tasks > MAX_PARTIALS:
            partials = partials.agg(*merged)
        state = steps.step(state, partials.collect(), epoch)  # one row per task, MAX_PARTIALS at most
    return state


def fit_logistic(df, lr=LEARNING_RATE, epochs=EPOCHS, l2=L2, names=FEATURES, label=LABEL, held_rows=HELD_ROWS):
    names = list(names)
    width = len(names)
    schema = T.StructType([T.StructField(f"g{j}", T.DoubleType()) for j in range(width + 1)])
    with TrainingTable(df, names, label) as table:
        moments = feature_moments(table.columns(), names).first()
        means = np.array([moments[f"mean_{n}"] for n in names])
        deviations = np.array([moments[f"sd_{n}"] for n in names])
        c = table.counts
        steps = _Steps(lr, epochs, l2, c["samples"], c["w_pos"], c["w_neg"])
        state = np.append(np.zeros(width), table.prior_log_odds)
        if c["samples"] <= held_rows:
            table.deal(1)
            state = _in_one_task(table.packed(_standardize(means, deviations)), schema, steps, state)
        else:
            rows = table.keep(_standardize(means, deviations))
            state = _job_by_job(rows, schema, steps, state, table.tasks)
    return LogisticModel(state[:-1].tolist(), float(state[-1]), means.tolist(), deviations.tolist(), names)
