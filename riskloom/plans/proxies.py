"""Credit inputs derived from the given tables; the same SQL text runs in Spark and in DuckDB."""

APPLICATION_RAW = """
SELECT seq,
 CASE WHEN seq=3 THEN concat('bad-', cast(c_custkey AS string)) ELSE cast(c_custkey AS string) END AS ID,
 CASE WHEN c_custkey%2=0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
 CASE WHEN c_mktsegment='AUTOMOBILE' THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
 CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD') THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
 cast(c_custkey%4 AS string) AS CNT_CHILDREN,
 CASE WHEN c_custkey%23=0 THEN 'n/a'
      ELSE cast(cast(floor((c_acctbal+1000)*27) AS bigint)*seq AS string) END AS AMT_INCOME_TOTAL,
 CASE WHEN c_custkey%6=0 THEN 'Pensioner' ELSE 'Working' END AS NAME_INCOME_TYPE,
 CASE WHEN c_custkey%3=0 THEN 'Higher education' ELSE 'Secondary' END AS NAME_EDUCATION_TYPE,
 CASE WHEN c_custkey%5<3 THEN 'Married' ELSE 'Single' END AS NAME_FAMILY_STATUS,
 'House / apartment' AS NAME_HOUSING_TYPE,
 cast(-(7300+(c_custkey*37)%18000) AS string) AS DAYS_BIRTH,
 CASE WHEN c_custkey%6=0 THEN '365243' ELSE cast(-((c_custkey*53)%14000) AS string) END AS DAYS_EMPLOYED,
 '1' AS FLAG_MOBIL,
 cast(c_custkey%2 AS string) AS FLAG_WORK_PHONE,
 cast((c_custkey+1)%2 AS string) AS FLAG_PHONE,
 CASE WHEN c_custkey%7=0 THEN '1' ELSE '0' END AS FLAG_EMAIL,
 CASE WHEN c_custkey%3=1 THEN '  ' WHEN c_custkey%3=2 THEN 'Laborers' ELSE 'Managers' END AS OCCUPATION_TYPE,
 CASE WHEN c_custkey%17=0 THEN '0' WHEN c_custkey%19=0 THEN ''
      ELSE concat(cast(1+c_custkey%5 AS string),'.0') END AS CNT_FAM_MEMBERS
FROM (SELECT *, {three} AS seq FROM {customer}) c
WHERE seq=1 OR (seq=2 AND c_custkey%10=0) OR (seq=3 AND c_custkey%50=49)
"""

CREDIT_RAW = """
SELECT cast(o_custkey AS string) AS ID,
 cast(-((2001-year(o_orderdate))*12+(8-month(o_orderdate))) AS string) AS MONTHS_BALANCE,
 CASE WHEN o_orderkey%211<2 THEN '5' WHEN o_orderkey%211<4 THEN '3' WHEN o_orderkey%211<8 THEN '2'
      WHEN o_orderkey%211<20 THEN '1' WHEN o_orderkey%211<80 THEN '0 ' WHEN o_orderkey%211<150 THEN 'C'
      WHEN o_orderkey%211<209 THEN 'X' ELSE '?' END AS STATUS
FROM {orders}
"""

SCORED = """
SELECT event_id AS customer_id, CASE WHEN event_type IN ('error','signup') THEN 1 ELSE 0 END AS y,
 value/(value+100.0e0) AS p FROM {events}
"""

# Scores in clusters whose members are closer than the tie rule's 1e-9, so that it chains.
CLOSE = """
SELECT event_id AS customer_id, CASE WHEN event_type IN ('error','signup') THEN 1 ELSE 0 END AS y,
 floor(value)/(value+100.0e0-(value-floor(value)))+(event_id%7)*0.0000000004e0 AS p FROM {events}
"""

SCORE_LOG = """
SELECT event_id AS score_id, user_id AS customer_id, cast(300+event_id%551 AS int) AS credit_score,
 value/(value+100.0e0) AS probability_of_default, CASE WHEN event_id%97=0 THEN NULL ELSE ts END AS scored_at
FROM {events}
"""

SCORE_REQUESTS = """
SELECT CASE WHEN c_custkey%11=0 THEN NULL ELSE c_custkey END AS customer_id,
 (7300+(c_custkey*37)%18000)/365.25e0 AS age_years,
 CASE WHEN c_custkey%6=0 THEN 0.0e0 ELSE ((c_custkey*53)%14000)/365.25e0 END AS employment_years,
 CASE WHEN c_custkey%4=0 THEN NULL ELSE 0.0e0 END AS is_unemployed_or_retired,
 (c_acctbal+1000)*27 AS annual_income,
 CASE WHEN c_custkey%3=0 THEN (c_acctbal+1000)*9 END AS income_per_family_member,
 cast(c_custkey%4 AS double) AS children_count, cast(c_custkey%6 AS double) AS family_members_count,
 cast(c_custkey%2 AS double) AS own_car, cast(c_custkey%3 AS double) AS own_realty,
 1.0e0 AS has_work_phone, 0.0e0 AS has_email,
 cast(c_custkey%60 AS double) AS credit_history_length_months,
 (c_custkey%20)/20.0e0 AS historical_delinquency_rate,
 cast(c_custkey%7 AS double) AS max_past_due_severity, (c_custkey%6)/6.0e0 AS delinquency_rate_last_6m
FROM {customer}
"""


def _run(spark, text, table, sf_dir):
    return spark.sql(
        text.replace("{three}", "explode(array(1, 2, 3))"),
        **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def application_raw(spark, sf_dir):
    return _run(spark, APPLICATION_RAW, "customer", sf_dir)


def credit_raw(spark, sf_dir):
    return _run(spark, CREDIT_RAW, "orders", sf_dir)


def scored(spark, sf_dir):
    return _run(spark, SCORED, "events", sf_dir)


def close(spark, sf_dir):
    return _run(spark, CLOSE, "events", sf_dir)


def score_log(spark, sf_dir):
    return _run(spark, SCORE_LOG, "events", sf_dir)


def score_requests(spark, sf_dir):
    return _run(spark, SCORE_REQUESTS, "customer", sf_dir)


def duckdb_text(text):
    for table in ("customer", "orders", "events"):
        text = text.replace("{%s}" % table, table)
    return text.replace("{three}", "unnest([1, 2, 3])").strip()
