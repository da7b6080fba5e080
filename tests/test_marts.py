import datetime

from pyspark.sql import functions as F

from riskloom.plans import marts
from riskloom.schemas import MART_SCORES, MART_SUMMARY
from riskloom.sources.tables import typed


def log_of(spark, rows):
    df = spark.createDataFrame(rows, "score_id long, customer_id long, credit_score int, scored_at timestamp")
    return typed(df.withColumns({
        "probability_of_default": F.lit(0.1), "risk_band": F.lit("Bueno"), "decision": F.lit("Aprobado"),
        "model_version": F.lit("v")}), MART_SCORES)


def test_latest_score_ties_and_missing_times(spark):
    early, late = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)
    log = log_of(spark, [(1, 1, 600, early), (2, 1, 610, late), (3, 1, 620, late),
                         (4, 2, 700, late), (5, 2, 710, None)])
    apps = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    got = {r.customer_id: r.credit_score for r in marts.latest_score(apps, log).collect()}
    assert got == {1: 620, 2: 710, 3: None}


def facts(spark, incomes):
    apps = spark.createDataFrame([(i, v) for i, v in incomes.items()], "customer_id long, annual_income double").select(
        "customer_id", F.col("annual_income").cast("decimal(14,2)").alias("annual_income"),
        F.lit(30.0).cast("decimal(5,2)").alias("age_years"))
    summary = apps.select("customer_id", F.lit(0.5).cast("decimal(6,4)").alias("historical_delinquency_rate"),
                          F.lit(1).alias("is_default"))
    return apps, summary


def test_kpis_count_log_rows(spark):
    apps, summary = facts(spark, {1: 100.0, 2: 400.0})
    now = datetime.datetime(2024, 1, 1)
    log = log_of(spark, [(1, 1, 600, now), (2, 1, 600, now), (3, 2, 603, now), (4, 9, 850, now)])
    row = marts.portfolio_kpis(apps, summary, log).first()
    assert (row.total_customers, row.avg_annual_income, row.avg_age) == (3, 200.0, 30.0)
    assert (row.avg_delinquency_rate_pct, row.avg_credit_score, row.empirical_default_rate_pct) == (50.0, 601.0, 100.0)


def test_hot_customer_is_counted_before_the_join(spark):
    """One customer with most of the log reaches the join as one row per band."""
    apps, summary = facts(spark, {i: float(i) for i in range(20)})
    log = log_of(spark, [(1, 1, 600, None)]).drop("score_id").crossJoin(spark.range(2000).withColumnRenamed("id", "score_id"))
    row = marts.portfolio_kpis(apps, summary, log).first()
    assert row.total_customers == 2000 and row.avg_annual_income == 1.0


def test_constraints_find_each_violation(spark):
    apps = spark.createDataFrame([(1, "F"), (1, "F"), (2, None)], "customer_id long, gender string")
    rows = [(1, 1), (3, 1), (3, 1)]
    summary = typed(spark.createDataFrame(rows, "customer_id long, is_default int").withColumns({
        f.name: F.lit(0) for f in MART_SUMMARY.fields if f.name not in ("customer_id", "is_default")}), MART_SUMMARY)
    log = log_of(spark, [(1, 1, 900, None), (1, 1, 700, None)])
    got = {r.rule: r.violations for r in marts.check_constraints(apps, summary, log).collect()}
    assert got["applications.customer_id is unique"] == 1
    assert got["applications.gender is not null"] == 1
    assert got["customer_credit_summary.customer_id is unique"] == 1
    assert got["customer_credit_summary.customer_id is in applications"] == 2
    assert got["credit_scores.score_id is unique"] == 1
    assert got["credit_scores.credit_score is in 300..850"] == 1
    assert "credit_scores.scored_at is not null" not in got


def test_every_table_is_checked_in_one_scan(spark, tmp_path):
    from riskloom.plans.portfolio import TABLES, empty_table

    tables = []
    for name, schema in TABLES.items():
        empty_table(spark, schema).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    apps, bureau, summary, scores = tables
    found = marts.check_constraints(apps, summary, scores, bureau)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4
    rows = found.collect()
    assert len(rows) > 40 and {r.violations for r in rows} == {0}
