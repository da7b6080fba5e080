"""Scorecards for whole tables, request batches, single customers and pages."""

from pyspark.sql import functions as F

from riskloom.functions import scorecard as C
from riskloom.operators import explain, paging
from riskloom.schemas import FEATURES
from riskloom.sources.requests import normalize_requests

RULE_MODEL_VERSION = "Rust-RandomForest-v1"
ACTIVE_MODEL = "Random Forest Classifier (Ensemble)"

# The rule-based probabilities.
RULE_DEFAULT, RULE_HIGH, RULE_SOME, RULE_NONE = 0.85, 0.25, 0.08, 0.005
HIGH_RATE = 0.3

SCORECARD_COLUMNS = [
    "customer_id", "probability_of_default", "credit_score", "risk_band", "decision",
    "factor_contributions",
]


def with_scores(df, probability="probability_of_default"):
    """Adds score, band and decision (enum names) of a probability column."""
    return (
        df.withColumn("credit_score", C.pdo_score(F.col(probability)))
        .withColumn("risk_band", C.risk_band(F.col("credit_score")))
        .withColumn("decision", C.decision(F.col("risk_band")))
    )


def with_labels(df):
    """Band and decision in Spanish, as lists and the mart show them.

    Column by column on purpose: a nested expression would repeat the score dozens of times.
    """
    return (
        df.withColumn("risk_band", C.risk_band(F.col("credit_score")))
        .withColumn("decision", C.decision_label(C.decision(F.col("risk_band"))))
        .withColumn("risk_band", C.band_label(F.col("risk_band")))
    )


def score_customers(df, model, means):
    """One scorecard per row of feature columns: narrow, no shuffle.

    ``means`` maps features to their portfolio mean (see :func:`means_of`).
    """
    factors = explain.factor_impacts(model.importances(), means)
    return with_scores(model.transform(df)).withColumn("factor_contributions", factors).select(
        *SCORECARD_COLUMNS)


def means_of(means_row):
    """The one-row result of ``feature_means`` as a dict: 15 numbers on the driver."""
    return {f: v for f, v in means_row.first().asDict().items() if v is not None}


def score_requests(requests, model, means):
    return score_customers(normalize_requests(requests), model, means)


def customer_scorecard(df, customer_id, model, means):
    """The scorecard of one customer; an unknown id gives no row."""
    return score_customers(paging.get_customer(df, customer_id), model, means)


def list_customers(df, model, page=None, limit=None, search=None):
    """One page in id order with Spanish labels. Only the rows of the page are scored.

    The number of all matches is ``total_count(search_customers(df, search))``.
    """
    rows = paging.page_of(paging.search_customers(df, search), page, limit)
    scored = model.transform(rows.select("customer_id", *FEATURES)).withColumn(
        "credit_score", C.pdo_score(F.col("probability_of_default")))
    return with_labels(scored).select(
        "customer_id",
        F.col("age_years").alias("age"),
        "annual_income",
        F.col("historical_delinquency_rate").alias("delinquency_rate"),
        "credit_score", "risk_band", "decision",
    ).orderBy("customer_id")


def model_info(metrics, active_model=ACTIVE_MODEL, names=FEATURES):
    """The evaluated models with the active one and the feature order on every row."""
    return metrics.withColumns({
        "active_model": F.lit(active_model),
        "feature_names": F.array(*[F.lit(n) for n in names]),
    })


def rule_scores(summary):
    """The rule-based score log: four probabilities from the default flag and the rounded rate."""
    rate = F.col("historical_delinquency_rate")
    p = (
        F.when(F.col("is_default") == 1, RULE_DEFAULT).when(rate > HIGH_RATE, RULE_HIGH)
        .when(rate > 0, RULE_SOME).otherwise(RULE_NONE)
    )
    scored = summary.select("customer_id", F.round(p, 4).alias("probability_of_default")).withColumn(
        "credit_score", C.pdo_score(F.col("probability_of_default"), clamp=False))
    return with_labels(scored).select(
        "customer_id", "credit_score", "probability_of_default", "risk_band", "decision")
