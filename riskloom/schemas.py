"""Fixed column orders and schemas of the credit data model."""

from pyspark.sql import types as T

# --- fixed values: the raw files, by position -------------------------------------------------
APPLICATION_COLUMNS = [
    "ID", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "CNT_CHILDREN", "AMT_INCOME_TOTAL",
    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "FLAG_MOBIL", "FLAG_WORK_PHONE", "FLAG_PHONE", "FLAG_EMAIL",
    "OCCUPATION_TYPE", "CNT_FAM_MEMBERS",
]
CREDIT_COLUMNS = ["ID", "MONTHS_BALANCE", "STATUS"]

# --- fixed values: the model's feature vector, in order ---------------------------------------
FEATURES = [
    "age_years", "employment_years", "is_unemployed_or_retired", "annual_income",
    "income_per_family_member", "children_count", "family_members_count", "own_car",
    "own_realty", "has_work_phone", "has_email", "credit_history_length_months",
    "historical_delinquency_rate", "max_past_due_severity", "delinquency_rate_last_6m",
]
LABEL = "is_default"

# Features that do not restate the label (max_past_due_severity >= 3 is the label itself).
LEAKAGE_FREE_FEATURES = [f for f in FEATURES if f != "max_past_due_severity"]

DEMOGRAPHIC_FEATURES = FEATURES[:11]
BEHAVIOUR_FEATURES = FEATURES[11:]

APPLICATION_RAW = T.StructType([T.StructField(c, T.StringType()) for c in APPLICATION_COLUMNS])
CREDIT_RAW = T.StructType([T.StructField(c, T.StringType()) for c in CREDIT_COLUMNS])

OPTIONAL_REQUEST_FIELDS = ("customer_id", "is_unemployed_or_retired", "income_per_family_member")
SCORE_REQUEST = T.StructType(
    [T.StructField("customer_id", T.LongType())]
    + [T.StructField(f, T.DoubleType()) for f in FEATURES]
)

FACTOR = T.StructType([
    T.StructField("feature_name", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("feature_value", T.DoubleType()),
    T.StructField("impact_direction", T.StringType()),
    T.StructField("relative_importance", T.DoubleType()),
    T.StructField("description", T.StringType()),
])


def _mart(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Column names, types and text lengths of the reporting tables.
TEXT_LENGTHS = {
    "applications": {
        "gender": 2, "income_type": 64, "education_type": 64, "family_status": 64, "housing_type": 64,
        "occupation_type": 64},
    "credit_bureau_records": {"status_code": 2},
    "customer_credit_summary": {},
    "credit_scores": {"risk_band": 32, "decision": 32, "model_version": 64},
}

MART_APPLICATIONS = _mart(
    ("customer_id", T.LongType(), False),
    ("gender", T.StringType(), False),
    ("own_car", T.BooleanType(), False),
    ("own_realty", T.BooleanType(), False),
    ("children_count", T.IntegerType(), False),
    ("annual_income", T.DecimalType(14, 2), False),
    ("income_type", T.StringType(), False),
    ("education_type", T.StringType(), False),
    ("family_status", T.StringType(), False),
    ("housing_type", T.StringType(), False),
    ("age_years", T.DecimalType(5, 2), False),
    ("employment_years", T.DecimalType(5, 2), False),
    ("is_unemployed_or_retired", T.BooleanType(), False),
    ("has_mobile", T.BooleanType(), False),
    ("has_work_phone", T.BooleanType(), False),
    ("has_phone", T.BooleanType(), False),
    ("has_email", T.BooleanType(), False),
    ("occupation_type", T.StringType(), True),
    ("family_members_count", T.DecimalType(4, 1), False),
    ("income_per_family_member", T.DecimalType(14, 2), False),
)

MART_BUREAU = _mart(
    ("record_id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("months_balance", T.IntegerType(), False),
    ("status_code", T.StringType(), False),
    ("severity_level", T.IntegerType(), False),
    ("is_past_due", T.BooleanType(), False),
    ("is_severe_delinquency", T.BooleanType(), False),
)

MART_SUMMARY = _mart(
    ("customer_id", T.LongType(), False),
    ("total_months_observed", T.IntegerType(), False),
    ("delinquent_months_count", T.IntegerType(), False),
    ("severe_delinquency_count", T.IntegerType(), False),
    ("historical_delinquency_rate", T.DecimalType(6, 4), False),
    ("max_past_due_severity", T.IntegerType(), False),
    ("delinquency_rate_last_6m", T.DecimalType(6, 4), False),
    ("is_default", T.IntegerType(), False),
)

MART_SCORES = _mart(
    ("score_id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("credit_score", T.IntegerType(), False),
    ("probability_of_default", T.DecimalType(7, 5), False),
    ("risk_band", T.StringType(), False),
    ("decision", T.StringType(), False),
    ("model_version", T.StringType(), False),
    ("scored_at", T.TimestampType(), True),
)
