import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from riskloom.operators import metrics as M, paging, ranking as R, ties
from riskloom.operators.split import stratified_split


def scored(spark, rows, parts=3):
    return spark.createDataFrame(
        [(i, int(y), float(p)) for i, (y, p) in enumerate(rows)], "customer_id long, y int, p double").repartition(parts)


def sample(n, seed, draw):
    rng = random.Random(seed)
    return [(rng.random() < 0.3, draw(rng)) for _ in range(n)]


SHAPES = {
    "continuous": lambda r: r.random(),
    "few values": lambda r: r.randrange(5) / 10,
    "hot value": lambda r: 0.25 if r.random() < 0.6 else r.random(),
    "chained": lambda r: 0.1 + r.randrange(400) * 4e-10,
    "lattice": lambda r: 0.5 + r.randrange(300) * 1e-10,
    "within one tie": lambda r: 1e-12 * r.random(),
    "dense then sparse": lambda r: 3e-9 * r.random() if r.random() < 0.5 else r.random(),
    "log uniform": lambda r: 10 ** -(15 * r.random()),
}


@pytest.mark.parametrize("shape,per_bucket", [(s, 40) for s in SHAPES] + [("chained", 10**6), ("hot value", 10**6)])
def test_areas_equal_brute_force(spark, shape, per_bucket):
    rows = sample(400, 7, SHAPES[shape])
    y, p, ids = [int(a) for a, _ in rows], [b for _, b in rows], list(range(len(rows)))
    df = scored(spark, rows)
    roc = M.roc_auc(df, rows_per_bucket=per_bucket).first()[0]
    pr = M.pr_auc(df, rows_per_bucket=per_bucket).first()[0]
    assert roc == pytest.approx(brute.roc_area(y, p), abs=1e-12)
    assert pr == pytest.approx(brute.average_precision(y, p, ids), abs=1e-12)


@pytest.mark.parametrize("shape", ["chained", "within one tie", "dense then sparse"])
def test_dense_values_over_many_buckets(spark, shape):
    """Buckets without a gap hand on many anchors; ranks are those of one bucket."""
    rows = sample(300, 3, SHAPES[shape])
    df = scored(spark, rows)
    want = {r.p: r.average_rank for r in ties.tie_average_rank(df, rows_per_bucket=10**6).collect()}
    got = {r.p: r.average_rank for r in ties.tie_average_rank(df, rows_per_bucket=17).collect()}
    assert got == want


def test_more_buckets_than_one_grid(spark, monkeypatch):
    rows = sample(900, 5, SHAPES["hot value"])
    df = scored(spark, rows)
    want = {r.customer_id: r["rank"] for r in R.distributed_rank(df, "p", "customer_id").collect()}
    monkeypatch.setattr(R, "_GRID", 8)
    got = {r.customer_id: r["rank"] for r in R.distributed_rank(df, "p", "customer_id", rows_per_bucket=9).collect()}
    assert got == want


def test_persisted_scores_in_a_fresh_session():
    """The optimizer must not push what it knows of a bucket to the side without the value."""
    code = """
from pyspark.sql import functions as F
from riskloom.session import local_session
from riskloom.operators import ties
spark = local_session("4", "3g")
scores = spark.range(6000).select((F.col("id") * 1e-13 + 0.5).alias("p"), F.lit(1).cast("long").alias("n")).persist()
scores.count()
rows = ties.tie_members(scores, rows_per_bucket=2000).collect()
assert len(rows) == 6000 and {r.anchor for r in rows} == {0.5}, len({r.anchor for r in rows})
"""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": root},
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_drawn_cut_points_change_no_result(spark, monkeypatch):
    rows = sample(600, 13, SHAPES["hot value"])
    df = scored(spark, rows)
    monkeypatch.setattr(R, "SKETCH_ROWS", 100)
    got = {r.customer_id: r["rank"] for r in R.distributed_rank(df, "p", "customer_id", rows_per_bucket=30).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], i))
    assert got == {i: k + 1 for k, i in enumerate(order)}


def test_tie_anchors_of_a_chain(spark):
    p = [0.5 + k * 6e-10 for k in range(4)]
    rows = scored(spark, [(0, v) for v in p])
    got = {r.p: r.average_rank for r in ties.tie_average_rank(rows, rows_per_bucket=1).collect()}
    assert [got[v] for v in p] == [1.5, 1.5, 3.5, 3.5]


def test_mean_ranks_by_group(spark):
    rows = sample(300, 5, SHAPES["hot value"])
    df = scored(spark, rows).withColumn("g", F.concat(F.lit("g"), F.col("customer_id") % 2))
    got = M.auc_by(df, "g", rows_per_bucket=15).orderBy("g").collect()
    for k, r in enumerate(got):
        mine = [(i, int(y), p) for i, (y, p) in enumerate(rows) if i % 2 == k]
        y, p, ids = [m[1] for m in mine], [m[2] for m in mine], [m[0] for m in mine]
        assert r.roc_auc == pytest.approx(brute.roc_area(y, p), abs=1e-12)
        assert r.pr_auc == pytest.approx(brute.average_precision(y, p, ids), abs=1e-12)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("per_bucket", [7, 10**6])
def test_rank_is_global_order(spark, ascending, per_bucket):
    rows = sample(500, 11, SHAPES["hot value"])
    df = scored(spark, rows)
    got = {r.customer_id: r["rank"] for r in R.distributed_rank(
        df, "p", "customer_id", ascending, rows_per_bucket=per_bucket).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] if ascending else -rows[i][1], i))
    assert got == {i: k + 1 for k, i in enumerate(order)}


def test_hot_value_is_cut_by_the_tie_column(spark):
    df = scored(spark, [(0, 0.5)] * 900 + [(1, 0.1)] * 100)
    pieces = R.bucketed(df, "p", "customer_id", rows_per_bucket=50).groupBy("_bucket", "_part").count().collect()
    assert len(pieces) > 15 and max(r["count"] for r in pieces) <= 110


def test_area_edges(spark):
    empty = scored(spark, [(0, 0.1)]).where("p > 1")
    assert M.roc_auc(empty).first()[0] == 0.5 and M.pr_auc(empty).first()[0] == 0.0
    one_class = scored(spark, [(1, 0.2), (1, 0.4)])
    assert M.roc_auc(one_class).first()[0] == 0.5
    assert M.roc_auc(scored(spark, [(0, .1), (0, .2), (0, .3), (1, .7), (1, .8), (1, .9)])).first()[0] == pytest.approx(1.0)
    row = M.evaluate(empty, "none").first().asDict()
    assert row.pop("model_name") == "none" and row.pop("roc_auc") == 0.5
    assert set(row.values()) == {0}
    assert len(M.METRIC_COLUMNS) == 13


def test_evaluate_counts_only_binary_labels(spark):
    df = scored(spark, [(1, .9), (0, .8), (0, .1), (1, .2), (2, .9)])
    r = M.evaluate(df, "m").first()
    assert (r.true_positives, r.false_positives, r.true_negatives, r.false_negatives, r.total_samples) == (1, 1, 1, 1, 5)
    assert r.accuracy == pytest.approx(0.4) and r.f1_score == pytest.approx(0.5)


def half_up(x):
    return math.floor(x + 0.5)


@pytest.mark.parametrize("frac", [0.8, 0.5, 0.0, 1.0])
def test_split_sizes_are_exact_and_stable(spark, frac):
    df = spark.range(1003).select(F.col("id").alias("customer_id"), (F.col("id") % 13 == 0).cast("double").alias("is_default"))
    marked = stratified_split(df, frac, 9)
    for label in (0.0, 1.0):
        part = marked.where(F.col("is_default") == label)
        assert part.where("is_train").count() == half_up(frac * part.count())
    again = stratified_split(df.repartition(7, "customer_id"), frac, 9)
    assert marked.where("is_train").select("customer_id").exceptAll(again.where("is_train").select("customer_id")).isEmpty()


def test_pages(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") * 3).alias("customer_id")).repartition(5)
    want = [i * 3 for i in range(1000)]
    assert paging.page_bounds(None, None) == (1, 20)
    assert paging.page_bounds(0, 500) == (1, 100) and paging.page_bounds(3, 0) == (3, 1)
    assert sorted(r[0] for r in paging.page_of(df, 2, 30).collect()) == want[30:60]
    monkeypatch.setattr(paging, "_SHALLOW", 10)  # every page is deep
    for offset, limit in [(0, 20), (5, 20), (730, 45), (990, 30), (1000, 5), (5000, 5)]:
        got = [r[0] for r in paging.list_recent(df, limit, offset, rows_per_bucket=40).collect()]
        assert got == want[offset:offset + limit], offset
    assert paging.total_count(df).first()[0] == 1000


@pytest.mark.parametrize("text,number", [(" 007 ", 7), ("abc", None), ("", None), (None, None), ("1.5", None),
                                         ("-3", -3), ("9" * 30, None)])
def test_search_text(text, number):
    assert paging.search_text_to_id(text) == number


def test_handover_equals_walk():
    rng = np.random.default_rng(1)
    for _ in range(200):
        p = np.unique(rng.integers(0, 60, 25) * rng.choice([1e-10, 3e-10, 1e-9, 4e-9]) + rng.random())
        table = ties._handover(p, 1e-9)
        carry = p[0] - rng.random() * 1.5e-9
        anchor, at = carry, ties._first_free(p, carry, 1e-9)
        while at < len(p):
            anchor, at = p[at], ties._first_free(p, p[at], 1e-9)
        enter, leave = table
        k = ties._first_free(enter, carry, 1e-9)
        assert (leave[k] if k < len(enter) else carry) == anchor


@pytest.mark.parametrize("fan", [2, 3, 64])
@pytest.mark.parametrize("step", [1e-10, 4e-10, 1.3e-9])
def test_handovers_in_a_tree_of_any_width(spark, monkeypatch, fan, step):
    """Chains that cross many buckets, with and without gaps, in two groups."""
    monkeypatch.setattr(ties, "FAN", fan)
    rng = np.random.default_rng(int(step * 1e12))
    p = np.cumsum(rng.choice([step, step * 1.7, 3e-9], 240, p=[0.6, 0.38, 0.02]))
    rows = [(g, float(v)) for g in ("a", "b") for v in (p if g == "a" else p[::2])]
    df = spark.createDataFrame(rows, "g string, p double")
    got = {(r.g, r.p): r.anchor for r in ties.tie_members(
        df.groupBy("g", "p").agg(F.count(F.lit(1)).alias("n")), groups=["g"], rows_per_bucket=9).collect()}
    for g, values in (("a", p), ("b", p[::2])):
        assert {v: a for (h, v), a in got.items() if h == g} == brute.anchored_groups(values)
