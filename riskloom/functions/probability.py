"""Logistic link and thresholding."""

from pyspark.sql import functions as F

LOGIT_LIMIT = 35.0


def stable_sigmoid(z):
    """1 from 35 upwards, 0 from -35 downwards, logistic between."""
    return (
        F.when(z >= LOGIT_LIMIT, F.lit(1.0))
        .when(z <= -LOGIT_LIMIT, F.lit(0.0))
        .otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    )


def hard_predict(p, threshold=0.5):
    """1 if ``p >= threshold``; NaN (which Spark sorts above every number) and NULL are 0."""
    return F.when(~F.isnan(p) & (p >= F.lit(float(threshold))), 1).otherwise(0)
