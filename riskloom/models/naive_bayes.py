"""Gaussian naive Bayes: one aggregate to fit, one column expression to predict."""

import math
from dataclasses import dataclass

from pyspark.sql import functions as F

from riskloom.models.base import Model, shares
from riskloom.operators.aggregates import VARIANCE_SMOOTHING, class_moments
from riskloom.schemas import FEATURES, LABEL

MIN_VARIANCE = 1e-9
MIN_POOLED_DEVIATION = 1e-6


@dataclass
class NaiveBayesModel(Model):
    prior_pos: float
    prior_neg: float
    means_pos: list
    vars_pos: list
    means_neg: list
    vars_neg: list
    features: list
    name: str = "Naive Bayes"

    def _log_joint(self, prior, means, variances):
        total = F.lit(math.log(prior))
        for n, m, v in zip(self.features, means, variances):
            v = max(v, MIN_VARIANCE)
            diff = F.col(n) - F.lit(m)
            total = total + F.lit(-0.5) * (
                F.lit(math.log(2.0 * math.pi) + math.log(v)) + diff * diff / F.lit(v))
        return total

    def log_odds(self):
        positive = self._log_joint(self.prior_pos, self.means_pos, self.vars_pos)
        negative = self._log_joint(self.prior_neg, self.means_neg, self.vars_neg)
        return positive - negative

    def feature_means(self):
        """Mean of each feature over both classes."""
        return {n: self.prior_pos * p + self.prior_neg * q
                for n, p, q in zip(self.features, self.means_pos, self.means_neg)}

    def importances(self):
        distances = [
            abs(mp - mn) / max(math.sqrt((vp + vn) / 2.0), MIN_POOLED_DEVIATION)
            for mp, vp, mn, vn in zip(self.means_pos, self.vars_pos, self.means_neg, self.vars_neg)
        ]
        return shares(distances)


def fit_naive_bayes(df, smoothing=VARIANCE_SMOOTHING, names=FEATURES, label=LABEL):
    names = list(names)
    by_class = {r["class"]: r for r in class_moments(df, names, label, smoothing).collect()}
    if set(by_class) != {0, 1}:
        raise ValueError("naive Bayes needs rows of both classes")
    pos, neg = by_class[1], by_class[0]
    total = pos["samples"] + neg["samples"]

    def vector(row, prefix):
        return [row[f"{prefix}_{n}"] for n in names]

    return NaiveBayesModel(
        pos["samples"] / total, neg["samples"] / total,
        vector(pos, "mean"), vector(pos, "var"), vector(neg, "mean"), vector(neg, "var"), names)
