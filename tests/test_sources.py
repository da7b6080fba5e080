import datetime
import json

import pytest
from pyspark.sql import functions as F

from riskloom.operators.history import dedupe_keep_last, summarize_history
from riskloom.plans import marts, portfolio
from riskloom.schemas import MART_SCORES
from riskloom.sources import csv, requests, tables
from riskloom.schemas import APPLICATION_COLUMNS


def application(id_, income="1000", car="N", family="2.0", occupation="Laborers", employed="-100", extra=""):
    return (f"{id_},F,{car},N,1,{income},Working,Secondary,Married,House,-12005,{employed},1,0,1,0,"
            f"{occupation},{family}{extra}")


@pytest.fixture
def apps_path(tmp_path):
    lines = [
        ",".join(APPLICATION_COLUMNS),
        application(1),
        "2,F,N",                                   # short
        application(3, extra=",surplus"),          # 19 fields
        application("x1"), application(" 7"), application("9.0"),
        application("+8"),
        application(1, income="2000"), application(1, income="3000", car="Y"),
        application(4, occupation='"a ""b"", c"'),
        application(5, occupation="", family=""), application(6, family="NaN"),
        application(10, occupation='"a, ""b"""', extra=',"x,y"'),
    ]
    path = tmp_path / "application_record.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_read_applications(spark, apps_path):
    df = csv.read_applications(spark, apps_path)
    assert sorted(r.customer_id for r in df.collect()) == [1, 1, 1, 3, 4, 5, 6, 8, 10]
    rows = {r.customer_id: r for r in dedupe_keep_last(df).collect()}
    assert rows[1].total_income == 3000.0 and rows[1].own_car
    assert rows[4].occupation_type == 'a "b", c'
    assert rows[10].occupation_type == 'a, "b"'
    assert rows[5].occupation_type is None and rows[5].family_members_count == 1.0
    assert rows[6].family_members_count != rows[6].family_members_count


def test_keep_last_over_file_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    rows = [application(i % 50, income=str(i)) for i in range(3000)]
    path.write_text("\n".join([",".join(APPLICATION_COLUMNS), *rows]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = csv.read_applications(spark, str(path))
        assert df.rdd.getNumPartitions() > 4
        got = {r.customer_id: r.total_income for r in dedupe_keep_last(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i: float(2950 + i) for i in range(50)}


def test_short_row_counts_even_when_few_columns_are_read(spark, apps_path):
    assert csv.read_applications(spark, apps_path).select("customer_id").count() == 9


def test_credit_records(spark, tmp_path):
    path = tmp_path / "credit.csv"
    path.write_text("ID,MONTHS_BALANCE,STATUS\n1,0, 2 \n1,abc,0\nx,0,0\n2,-3,?\n2,-3,\n")
    rows = csv.read_credit_records(spark, str(path)).orderBy("customer_id", "status_raw").collect()
    assert [(r.customer_id, r.months_balance, r.status) for r in rows] == [(1, 0, "2"), (2, -3, "0"), (2, -3, "0")]


@pytest.mark.parametrize("bad", ["1,0", "1,0,C,extra"])
def test_ragged_credit_row_fails_the_load(spark, tmp_path, bad):
    path = tmp_path / "ragged.csv"
    path.write_text(f"ID,MONTHS_BALANCE,STATUS\n1,0,C\n{bad}\n")
    with pytest.raises(Exception):
        csv.read_credit_records(spark, str(path)).select("customer_id").collect()


def request(**over):
    base = dict(age_years=30.0, employment_years=0.0, annual_income=100.0, children_count=0.0,
                family_members_count=0.0, own_car=0.0, own_realty=0.0, has_work_phone=0.0, has_email=0.0,
                credit_history_length_months=3.0, historical_delinquency_rate=0.0,
                max_past_due_severity=0.0, delinquency_rate_last_6m=0.0)
    base.update(over)
    return base


def test_requests_are_completed(spark, tmp_path):
    path = tmp_path / "requests.json"
    broken = request()
    del broken["age_years"]
    full = request(customer_id=5, is_unemployed_or_retired=0.5, income_per_family_member=7.0, family_members_count=4.0)
    path.write_text("\n".join(json.dumps(r) for r in [request(), full, broken]))
    with pytest.raises(Exception, match="missing: age_years"):
        requests.read_score_requests(spark, str(path)).collect()
    rows = requests.normalize_requests(requests.read_score_requests(spark, str(path), "skip")).orderBy("customer_id").collect()
    assert [r.customer_id for r in rows] == [5, 9999999]
    assert (rows[0].is_unemployed_or_retired, rows[0].income_per_family_member, rows[0].family_members_count) == (0.5, 7.0, 4.0)
    assert (rows[1].is_unemployed_or_retired, rows[1].income_per_family_member, rows[1].family_members_count) == (1.0, 100.0, 1.0)


def test_rejected_requests_are_told(spark, tmp_path):
    path = tmp_path / "requests.json"
    short = request(customer_id=2)
    del short["own_car"], short["has_email"]
    path.write_text("\n".join([json.dumps(request(customer_id=1)), json.dumps(short), '{"age_years": 3,', "[1"]))
    told = requests.read_rejected_requests(spark, str(path)).select("customer_id", "reason").collect()
    assert sorted((str(r[0]), r[1]) for r in told) == [
        ("2", "missing: own_car, has_email"), ("None", "malformed"), ("None", "malformed")]
    assert [r.customer_id for r in requests.read_score_requests(spark, str(path), "skip").collect()] == [1]
    with pytest.raises(Exception, match="rejected request"):
        requests.read_score_requests(spark, str(path)).collect()
    array = tmp_path / "array.json"
    array.write_text(json.dumps([request(customer_id=7), request(customer_id=8)], indent=2))
    assert requests.read_score_requests(spark, str(array), multiline=True).count() == 2
    with pytest.raises(ValueError):
        requests.complete_requests(spark.read.json(str(path)), "drop")


def test_quoted_line_breaks_are_read(spark, tmp_path):
    def line(i, job):
        return f'{i},M,Y,N,0,100.5,Working,Higher,"Married, ""yes""",House,-9000,-100,1,0,1,0,{job},2.0'

    path = tmp_path / "applications.csv"
    header = ",".join(APPLICATION_COLUMNS)
    path.write_text("\n".join([header, line(1, "Cook"), line(2, '"Lab\nassistant"'), line(3, "Driver"), "4,M", line("x", "")]))
    rows = csv.read_applications(spark, str(path)).orderBy("customer_id").collect()
    assert [(r.customer_id, r.occupation_type) for r in rows] == [(1, "Cook"), (2, "Lab\nassistant"), (3, "Driver")]
    told = {(r.reason, r.id) for r in csv.read_rejected_applications(spark, str(path)).collect()}
    assert told == {("fewer than 18 fields", "4"), ("no valid id", "x")}


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "customer_id long, v string")
    new = spark.createDataFrame([(1, "new", 0), (2, "second", 2), (2, "first", 1)], "customer_id long, v string, n int")
    got = {r.customer_id: r.v for r in tables.insert_if_absent(target, new, order="n").collect()}
    assert got == {1: "old", 2: "first"}


def test_append_scores_numbers_on(spark):
    empty = portfolio.empty_table(spark, MART_SCORES)
    new = spark.range(10).select(
        F.col("id").alias("customer_id"), F.lit(700).alias("credit_score"),
        F.lit(0.01).alias("probability_of_default"), F.lit("Bueno").alias("risk_band"), F.lit("Aprobado").alias("decision"))
    once = tables.append_scores(empty, new, "v1", "2024-01-01 00:00:00", rows_per_bucket=3)
    twice = tables.append_scores(once, new, "v2", "2024-02-01 00:00:00", rows_per_bucket=3)
    assert sorted(r.score_id for r in twice.collect()) == list(range(1, 21))
    assert {r.scored_at for r in twice.where("model_version = 'v2'").collect()} == {datetime.datetime(2024, 2, 1)}


def test_append_scores_of_one_hot_customer(spark):
    new = spark.range(400).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("customer_id"),
        (F.col("id") + 300).cast("int").alias("credit_score"), F.lit(0.01).alias("probability_of_default"),
        F.lit("Bueno").alias("risk_band"), F.lit("Aprobado").alias("decision"))
    log = tables.append_scores(portfolio.empty_table(spark, MART_SCORES), new, "v1", rows_per_bucket=20)
    assert sorted(r.score_id for r in log.collect()) == list(range(1, 401))


def test_write_mart_rejects_null(spark, tmp_path):
    bad = spark.createDataFrame([(1, None)], "score_id long, customer_id long").select(
        "score_id", "customer_id", F.lit(1).alias("credit_score"), F.lit(0.1).alias("probability_of_default"),
        F.lit("a").alias("risk_band"), F.lit("b").alias("decision"), F.lit("c").alias("model_version"),
        F.lit(None).cast("timestamp").alias("scored_at"))
    with pytest.raises(Exception, match="customer_id is NULL"):
        tables.write_mart(bad, str(tmp_path / "m"), MART_SCORES)
    good = tables.write_mart(bad.withColumn("customer_id", F.lit(1)), str(tmp_path / "ok"), MART_SCORES, ["risk_band"])
    assert good.count() == 1 and "risk_band" in good.columns


def test_refresh_marts_twice(spark, apps_path, tmp_path):
    credit = tmp_path / "credit.csv"
    credit.write_text("ID,MONTHS_BALANCE,STATUS\n1,0,2\n3,-1,C\n3,-2,0\n99,0,C\n")
    apps, records = portfolio.load(spark, apps_path, str(credit))
    target = str(tmp_path / "marts")
    portfolio.refresh_marts(spark, apps, records, target, 1, scored_at="2024-01-01 00:00:00")
    for _ in range(2):  # the second load, and the same load once more
        paths = portfolio.refresh_marts(spark, apps, records, target, 2, "2024-02-01 00:00:00")
    assert {r["load"] for r in spark.read.parquet(paths["applications"]).collect()} == {1}  # only new rows
    assert portfolio.read_mart(spark, target, "customer_credit_summary").count() == 2
    bureau = portfolio.read_mart(spark, target, "credit_bureau_records")
    assert sorted(r.record_id for r in bureau.collect()) == list(range(1, 9))
    log = portfolio.read_mart(spark, target, "credit_scores")
    broken = {r.rule: r.violations for r in marts.check_constraints(
        portfolio.read_mart(spark, target, "applications").withColumn("gender", F.lit("long")),
        portfolio.read_mart(spark, target, "customer_credit_summary"), log, bureau).collect() if r.violations}
    assert broken == {"applications.gender has at most 2 characters": 2}
    with pytest.raises(Exception, match="longer than 2"):
        tables.write_mart(bureau.withColumn("status_code", F.lit("abc")), str(tmp_path / "long"),
                          portfolio.MART_BUREAU, lengths={"status_code": 2})
    assert sorted(r.score_id for r in log.collect()) == [1, 2, 3, 4]
    kpis = spark.table("v_portfolio_risk_kpis").collect()
    assert sum(r.total_customers for r in kpis) == 4  # a rerun doubles the counts
    profile = spark.table("v_customer_risk_profile")
    assert profile.count() == 2 and len(profile.columns) == 21
    assert {r.customer_id: r.credit_score for r in profile.collect()} == {1: 375, 3: 518}


def test_edge_history(spark):
    rows = [(1, 2, "0"), (1, 1, "C"), (2, -10, "2"), (2, -10, "2"), (3, -5, "0"), (3, -6, "C")]
    records = spark.createDataFrame(rows, "customer_id long, months_balance int, status string").withColumn(
        "status_raw", F.col("status"))
    got = {r.customer_id: r for r in summarize_history(records).collect()}
    assert (got[1].min_month_balance, got[1].max_month_balance) == (0, 2)
    assert got[1].recent_delinquency_rate_6m == 0.5 and got[1].months_since_last_delinquency == -2
    assert got[2].total_months_observed == 2 and got[2].recent_delinquency_rate_6m == 0.0
    assert got[2].is_bad_customer and got[2].max_severity == 3.0 and got[2].months_since_last_delinquency == 10
    assert got[3].recent_delinquency_rate_6m == 1.0 and got[3].delinquency_rate == 0.5


def _quoted_application(i, job):
    return f'{i},M,Y,N,0,100.5,Working,Higher,"Married, ""yes""",House,-9000,-100,1,0,1,0,{job},2.0'


@pytest.mark.parametrize("split_bytes", [300, 1000, 10**7])
def test_quoted_line_breaks_over_splits(spark, tmp_path, split_bytes):
    """Two files in splits of a few lines: every record once, in order, whatever the splits cut."""
    jobs = ["Cook", '"Lab\nassistant"', '"a ""b"",\n\n"","" c\nd"', '5" pipes', '"x"', "", '"' + "long\n" * 40 + '"']
    want = {}
    for number in range(2):
        ids = range(number * 100, number * 100 + 60)
        lines = [_quoted_application(i, jobs[i % len(jobs)]) for i in ids]
        lines[7:7] = ["", "7,M"]
        (tmp_path / f"part{number}.csv").write_text("\n".join([",".join(APPLICATION_COLUMNS), *lines]) + "\n")
        plain = {'"Lab\nassistant"': "Lab\nassistant", '"a ""b"",\n\n"","" c\nd"': 'a "b",\n\n"," c\nd', '"x"': "x", "": None,
                 jobs[6]: "long\n" * 40}
        want |= {i: plain.get(jobs[i % len(jobs)], jobs[i % len(jobs)]) for i in ids}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        df = csv.read_applications(spark, str(tmp_path))
        rows = df.orderBy("file_order").collect()
        assert [r.customer_id for r in rows] == list(want)
        assert {r.customer_id: r.occupation_type for r in rows} == want
        assert csv.read_rejected_applications(spark, str(tmp_path)).count() == 2
        if split_bytes < 1000:
            assert df.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stray_quote_joins_no_lines(spark, tmp_path):
    path = tmp_path / "credit.csv"
    path.write_text('ID,MONTHS_BALANCE,STATUS\n1,0,2"\n2,-1,C\n3,-2,"X"\n')
    rows = csv.read_credit_records(spark, str(path)).orderBy("customer_id").collect()
    assert [(r.customer_id, r.status_raw) for r in rows] == [(1, '2"'), (2, "C"), (3, "X")]
    path.write_text('ID,MONTHS_BALANCE,STATUS\n1,0,"a\nb"\n2,-1\n')
    with pytest.raises(Exception, match="not three fields"):
        csv.read_credit_records(spark, str(path)).select("customer_id").collect()


def test_ends_inside():
    from riskloom.sources.records import ends_inside

    for line, outside, inside in [
        ("a,b", False, True), ('a,"b"', False, False), ('a,"b', True, False), ('"', True, False), ('""', False, True),
        ('"""', True, False), ('5" x,"y"', False, False), ('a,"b ""c"', False, False), ("", False, True), ('x",y', False, False),
        ('x",y,"', True, True),
    ]:
        assert ends_inside(line, False) == outside, line
        assert ends_inside(line, True) == inside, line


def test_rows_are_numbered_in_order_without_a_sort(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 > 0")
    numbered, rows = tables.in_order(df, "n", 100)
    got = sorted((r.id, r.n) for r in numbered.collect())
    assert rows == len(got) and [n for _, n in got] == list(range(101, 101 + rows))
    assert tables.in_order(df.limit(0), "n")[0].collect() == []


def test_id_blocks_go_on_and_loads_keep_theirs(spark, tmp_path):
    start = lambda load, rows, name="t": tables.id_start(spark, str(tmp_path), name, load, rows)
    assert start(1, 10) == 0 and start(2, 5) == 10 and start(1, 3, "other") == 0
    assert start(2, 9) == 10    # the last load may grow in place
    assert start(1, 4) == 0     # fewer rows fit the old block
    assert start(3, 1) == 19
    assert start(1, 12) == 20   # grown in the middle: a new block
    assert start(4, 1) == 32
