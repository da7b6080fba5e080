"""From the two raw files to features, models and the reporting tables."""

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskloom.operators.features import build_dataset
from riskloom.operators.history import dedupe_keep_last, summarize_history
from riskloom.operators.scoring import RULE_MODEL_VERSION, rule_scores
from riskloom.plans import marts
from riskloom.schemas import MART_APPLICATIONS, MART_BUREAU, MART_SCORES, MART_SUMMARY, TEXT_LENGTHS
from riskloom.sources.csv import read_applications, read_credit_records
from riskloom.sources.tables import id_start, in_order, new_scores, rows_absent, typed, write_mart


def load(spark, applications_path, credit_path):
    """(one application per customer, bureau records) from the CSV files."""
    apps = dedupe_keep_last(read_applications(spark, applications_path))
    return apps, read_credit_records(spark, credit_path)


def training_table(apps, records):
    return build_dataset(apps, summarize_history(records))


def empty_table(spark, schema):
    return spark.createDataFrame([], schema)


TABLES = {
    "applications": MART_APPLICATIONS, "credit_bureau_records": MART_BUREAU,
    "customer_credit_summary": MART_SUMMARY, "credit_scores": MART_SCORES,
}


def read_mart(spark, target, name, but=None):
    """All loads of a mart table, or all but one; an empty table before the first."""
    try:
        loads = spark.read.parquet(f"{target.rstrip('/')}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty_table(spark, TABLES[name])
    if but is not None:
        loads = loads.where(F.col("load") != but)
    return typed(loads, TABLES[name])


def refresh_marts(spark, apps, records, target, load, scored_at=None):
    """Append a load to the four mart tables under ``target``; returns their paths.

    Customers that a table already has keep their rows, and only new rows are written: a load is one
    partition. Bureau records and scores are logs, each load adds its own with ids that go on from
    a table of id blocks, without a look at the logs. Repeating a load replaces its partition.
    """
    root = target.rstrip("/")

    def old(name):
        return read_mart(spark, root, name, load)

    def put(name, rows):
        write_mart(rows, f"{root}/{name}/load={load}", TABLES[name], lengths=TEXT_LENGTHS[name])

    put("applications", rows_absent(marts.mart_applications(apps, records), old("applications")))
    months, rows = in_order(marts.bureau_months(records), "record_id")
    start = id_start(spark, root, "credit_bureau_records", load, rows)
    put("credit_bureau_records", months.withColumn("record_id", F.col("record_id") + start))
    matched = marts.mart_credit_summary(apps, records).persist(StorageLevel.MEMORY_AND_DISK)
    put("customer_credit_summary", rows_absent(matched, old("customer_credit_summary")))
    start = id_start(spark, root, "credit_scores", load, matched.count())
    put("credit_scores", new_scores(rule_scores(matched), RULE_MODEL_VERSION, start, scored_at))
    matched.unpersist()
    marts.create_views(*[read_mart(spark, root, n) for n in (
        "applications", "customer_credit_summary", "credit_scores")])
    return {name: f"{root}/{name}" for name in TABLES}


def flagship(apps, records):
    """Customers with features, label and rule score: the whole path from raw rows to a decision."""
    features = training_table(apps, records)
    scores = rule_scores(summarize_history(records, "mart"))
    return features.join(scores, "customer_id").select(
        "customer_id", F.round("age_years", 4).alias("age_years"), "annual_income",
        "credit_history_length_months",
        F.round("historical_delinquency_rate", 6).alias("historical_delinquency_rate"),
        "is_default", "credit_score", "probability_of_default", "risk_band", "decision")
