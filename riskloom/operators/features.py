"""Joins of applications with summaries, and the 15-column feature table.

Both sides hold one row per customer, so no join key can be hot.
"""

from pyspark.sql import functions as F

from riskloom.functions import demographics as D
from riskloom.schemas import FEATURES, LABEL


def _demographic_columns():
    years, idle = D.employment(F.col("days_employed"))
    family = D.family_members(F.col("family_members_count"))
    return {
        "age_years": D.age_years(F.col("days_birth")),
        "employment_years": years,
        "is_unemployed_or_retired": idle,
        "annual_income": F.col("total_income"),
        "income_per_family_member": D.income_per_member(F.col("total_income"), family),
        "children_count": F.col("children_count").cast("double"),
        "family_members_count": family,
        "own_car": D.flag_to_double(F.col("own_car")),
        "own_realty": D.flag_to_double(F.col("own_realty")),
        "has_work_phone": D.flag_to_double(F.col("has_work_phone")),
        "has_email": D.flag_to_double(F.col("has_email")),
    }


def _behaviour_columns():
    def known(name):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    return {
        "credit_history_length_months": known("total_months_observed"),
        "historical_delinquency_rate": known("delinquency_rate"),
        "max_past_due_severity": known("max_severity"),
        "delinquency_rate_last_6m": known("recent_delinquency_rate_6m"),
    }


def _feature_table(apps, summary, how):
    columns = {**_demographic_columns(), **_behaviour_columns()}
    return apps.join(summary, "customer_id", how).select(
        "customer_id",
        *[columns[f].alias(f) for f in FEATURES],
        F.col("is_bad_customer").cast("double").alias(LABEL),
    )


def build_dataset(apps, summary):
    """Customers with both an application and a history: the training table."""
    return _feature_table(apps, summary, "inner")


def build_features(apps, summary):
    """Every applicant; without history the behaviour features are 0 and the label is NULL."""
    return _feature_table(apps, summary, "left")


def with_history(apps, records):
    """Applications that have bureau rows. Ids are made distinct before the shuffle."""
    return apps.join(records.select("customer_id").distinct(), "customer_id", "left_semi")


def feature_array(names=FEATURES):
    """The feature vector as one array column."""
    return F.array(*[F.col(n) for n in names])
