"""Boosted trees: every round fits the label again with weights from the trees so far.

The sign of the residual is the label itself, so only the weights change. They are recomputed
in the tasks from the nodes; no DataFrame grows from round to round.
"""

from dataclasses import dataclass

import numpy as np

from riskloom.functions.probability import LOGIT_LIMIT
from riskloom.models.trees import (
    Nodes, ResidualWeights, TreeModel, ValueTable, fit_nodes)
from riskloom.schemas import FEATURES, LABEL

ROUNDS, RATE, DEPTH, MIN_SPLIT = 20, 0.1, 4, 15


@dataclass
class BoostingModel(TreeModel):
    base: float
    rate: float
    nodes: Nodes
    features: list
    name: str = "Gradient Boosting"

    def combine(self, walk, x):
        z = walk.boosted_score(x, self.base, self.rate)
        with np.errstate(over="ignore"):
            p = 1.0 / (1.0 + np.exp(-z))
        return np.where(z >= LOGIT_LIMIT, 1.0, np.where(z <= -LOGIT_LIMIT, 0.0, p))

    def importances(self):
        """Uniform: the model keeps no importance of its own."""
        return [1.0 / len(self.features)] * len(self.features)


def fit_boosting(df, rounds=ROUNDS, lr=RATE, depth=DEPTH, min_split=MIN_SPLIT, names=FEATURES,
                 label=LABEL, key="customer_id"):
    nodes, everything = Nodes(), [list(range(len(names)))]
    with ValueTable(df, names, label, key) as table:
        base = table.prior_log_odds
        for _ in range(rounds):
            weights = ResidualWeights(nodes.arrays(), base, lr)
            nodes.extend(fit_nodes(table, 1, depth, min_split, everything, weights))
    return BoostingModel(base, lr, nodes, list(names))
