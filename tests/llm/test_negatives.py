"""Hard negatives against all pairs in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import negatives


def brute(rows, positives=5, negatives_=5, low=80):
    """``rows`` of (id, label, vector) -> the result rows."""
    fine = [(i, str(lb), [math.floor(256 * x) for x in v]) for i, lb, v in rows
            if None not in (i, lb, v) and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], {}
    for i, lb, v in sorted(fine):
        if i % 100 == 0:
            seen.setdefault(i, (lb, v))
    for a, (label, vector) in seen.items():
        def ranked(same):
            scored = [(-sum(x * y for x, y in zip(vector, v)), i) for i, lb, v in fine if i != a and (lb == label) == same]
            return [(-s, i) for s, i in sorted(scored)]
        others = ranked(False)
        for p, i in ranked(True)[:positives]:
            inside = [(s, j) for s, j in others if low * p <= 100 * s <= 100 * p]
            out += [(a, i, n + 1, j, p, s) for n, (s, j) in enumerate(inside[:negatives_])]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **how).collect()))


def vectors(seed, n, dims=6, levels=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x = np.round(x * levels) / levels if levels else x
    return [(i, int(rng.integers(3)), x[i].astype(float).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,levels", [(1, None), (2, 2), (3, 1)])
def test_equals_all_pairs(spark, seed, levels):
    rows = vectors(seed, 450, levels=levels)
    assert mined(spark, rows) == brute(rows)


def test_small_cells_and_batches(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS_PER_CELL", 2)
    monkeypatch.setattr(negatives, "PAIRS_AT_ONCE", 40)
    rows = vectors(5, 620, levels=2)
    assert mined(spark, rows, positives=3, negatives=2, low=50) == brute(rows, 3, 2, 50)


def test_hot_vector_and_ties(spark):
    """One vector and one label hold most rows."""
    rows = [(i, 1 if i % 3 else 2, [0.5, 0.25]) for i in range(700)] + [(1000 + i, 1, [0.4, 0.3]) for i in range(50)]
    assert mined(spark, rows) == brute(rows)


def test_hostile_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (0, 2, [0.5, 0.5]), (1, 1, [0.9, 0.1]), (1, 1, [0.9, 0.1]),
        (2, 2, [0.85, 0.1]), (2, 2, [0.85, 0.1]), (3, 2, [0.88]), (4, 2, []), (5, None, [1.0, 1.0]),
        (6, 2, None), (7, 2, [0.9, None]), (8, 2, [nan, 0.9]), (9, 2, [inf, 0.9]), (None, 2, [0.9, 0.1]),
        (100, 3, [1.0, 1.0]), (200, None, [1.0, 1.0]), (-100, 1, [0.9, -0.1]), (-7, 2, [0.9, 0.0]),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and got
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1.0])]) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_large_components_stay_exact(spark):
    big = float(2 ** 22)
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 0.5]), (2, 2, [big, 0.25]), (3, 2, [big, 0.125]), (4, 2, [big / 2, 9.0])]
    assert mined(spark, rows) == brute(rows)
    huge = [(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [1e30]), (3, 2, [5.0])]
    most = np.iinfo(np.int64).max
    assert [r[3:] for r in mined(spark, huge)] == [(2, most, most), (3, most, most)]


def test_other_columns_and_types(spark):
    rows = vectors(9, 210)
    df = spark.createDataFrame([(*r, 1, 2, "k") for r in rows],
                               "vec_id long, label int, embedding array<double>, id int, cell int, `key` string")
    got = negatives.mine(df.withColumn("label", F.col("label").cast("string")), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_query(spark, sf, tmp_path):
    from riskloom.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    moved = [(i, (lb + 1) % 10 if i % 7 == 0 else lb, v) for i, lb, v in rows]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, sf).collect())) == brute(moved)


def test_packed_keys_sort_like_pairs():
    rng = np.random.default_rng(0)
    ends = np.array([np.iinfo(np.int64).min, np.iinfo(np.int64).max, -1, 0, 1])
    a, s, i = (np.concatenate([ends, rng.integers(-5, 5, 200)]) for _ in range(3))
    for v in (s, i):
        rng.shuffle(v)
    kind = rng.integers(0, 2, len(a)).astype(np.uint8)
    keys = negatives.pack(a, s, kind, i)
    for want, got in zip((a, s, kind, i), negatives.unpack(keys)):
        assert (want == got).all()
    order = sorted(range(len(a)), key=lambda n: (int(a[n]), -int(s[n]), int(kind[n]), int(i[n])))
    assert [keys[n].as_py() for n in order] == sorted(keys.to_pylist())
