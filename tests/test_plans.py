"""The registered queries against their SQL, and the shape of the physical plans."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import check
from riskloom.operators import metrics as M, ranking as R
from riskloom.operators.split import stratified_split
from riskloom.plans import queries as Q
from riskloom.plans.oracles import ORACLES
from riskloom.plans.queries import REGISTRY

@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_is_covered():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"gb_importance", "lr_fit", "lr_importance"}))  # long fits: see check.py
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert check.canonical(df.columns, df.collect()) == check.canonical(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_single_partition(plan):
    """Exchanges to one partition that are not fed by a partial aggregate or a top-n."""
    lines, bad = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "SinglePartition" in line and not re.search(r"partial_|Aggregate", " ".join(lines[i + 1:i + 3])):
            bad.append(line)
    return bad


def test_no_task_gets_all_rows(spark, sf):
    scored = Q.X.scored(spark, sf)
    for df in (M.roc_auc(scored, rows_per_bucket=100), M.pr_auc(scored, rows_per_bucket=100),
               R.distributed_rank(scored, "p", "customer_id", rows_per_bucket=100)):
        assert raw_single_partition(physical(df)) == []


def test_split_broadcasts_two_rows_and_scans_without_shuffle(spark, dataset):
    plan = physical(stratified_split(dataset))
    assert raw_single_partition(plan) == []
    assert "SortMergeJoin" not in plan


def test_columns_are_pruned_at_the_scan(spark, sf):
    plan = physical(Q.credit_summary(spark, sf))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"o_orderkey", "o_custkey", "o_orderdate"}


def test_point_lookup_filter_reaches_the_scan(spark, tmp_path, dataset):
    dataset.write.parquet(str(tmp_path / "features"))
    stored = spark.read.parquet(str(tmp_path / "features"))
    assert "EqualTo(customer_id,77)" in physical(Q.paging.get_customer(stored, 77))


def test_results_do_not_depend_on_shuffle_partitions(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = sorted(map(tuple, Q.credit_summary(spark, sf).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        second = sorted(map(tuple, Q.credit_summary(spark, sf).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == second
