"""Split, fit the four models, evaluate them on the held-out rows; the forest is the champion."""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from riskloom.models.boosting import fit_boosting
from riskloom.models.forest import fit_random_forest
from riskloom.models.logistic import fit_logistic
from riskloom.models.naive_bayes import fit_naive_bayes
from riskloom.operators.metrics import evaluate_by
from riskloom.operators.split import stratified_split
from riskloom.schemas import FEATURES, LABEL

# Model names in the metrics table, in order of evaluation.
LOGISTIC, BAYES, FOREST, BOOSTING = (
    "Logistic Regression", "Naive Bayes", "Random Forest", "Gradient Boosting")
CHAMPION = FOREST


@dataclass
class Comparison:
    metrics: DataFrame
    models: dict

    @property
    def champion(self):
        return self.models[CHAMPION]


def fit_all(train, seed=42, names=FEATURES):
    return {
        LOGISTIC: fit_logistic(train, names=names),
        BAYES: fit_naive_bayes(train, names=names),
        FOREST: fit_random_forest(train, seed=seed, names=names),
        BOOSTING: fit_boosting(train, names=names),
    }


def score_with_all(df, models, key="customer_id", label=LABEL):
    """One row per (customer, model): all models score a row in the same pass."""
    columns = {f"p{i}": m.probability() for i, m in enumerate(models.values())}
    wide = df.select(key, F.col(label).cast("int").alias("y"), *[c.alias(n) for n, c in columns.items()])
    per_model = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.col(f"p{i}").alias("p"))
        for i, name in enumerate(models)
    ])
    return wide.select(key, "y", F.inline(per_model))


def compare_models(df, seed=42, names=FEATURES, threshold=0.5):
    """A :class:`Comparison` with one metrics row per model and the fitted models."""
    marked = stratified_split(df, 0.8, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = fit_all(marked.where("is_train"), seed, names)
        scored = score_with_all(marked.where(~F.col("is_train")), models).persist(
            StorageLevel.MEMORY_AND_DISK)
        result = evaluate_by(scored, "model_name", threshold=threshold)
        rows = {r["model_name"]: r for r in result.collect()}  # four rows
        scored.unpersist()
    finally:
        marked.unpersist()
    metrics = df.sparkSession.createDataFrame([rows[m] for m in models if m in rows], result.schema)
    return Comparison(metrics, models)
