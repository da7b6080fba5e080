"""What a task of a tree fit holds does not grow with the table."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.models import splits, trees
from riskloom.models.base import BLOCKS, TrainingTable


def test_a_scan_of_few_files_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("riskloom.models.base.ROWS_PER_TASK", 100)
    df = spark.range(2_000).coalesce(1).select(
        F.col("id").alias("customer_id"), F.col("id").cast("double").alias("a"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    with TrainingTable(df, ["a"], "y") as table:
        assert table.rows.rdd.getNumPartitions() == 20
        assert table.rows.agg(F.count("id"), F.sum("id")).first() == (2_000, 1_999_000)


def test_runs_leave_feature_by_feature():
    rows, width, count = 3_000, 3, 5
    draw = np.random.default_rng(4)
    x, y = draw.random((rows, width)), (np.arange(rows) % 2).astype(np.uint8)
    block = pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (
        y, x, np.ones((rows, count), np.uint8))], BLOCKS.names)
    nodes = trees.Nodes()
    for t in range(count):
        nodes.add(t, 0)
    run = trees._level_pass(nodes.arrays(), list(range(count)), np.arange(count), [[0, 1, 2]] * count,
                            None, width, trees.ClassWeights())
    sent = list(run([block]))
    assert len(sent) == count * width
    assert all(sum(len(d.as_py()) for d in b.column("data")) == 32 * rows for b in sent)


def test_runs_of_a_key_are_merged_on_the_way(monkeypatch):
    monkeypatch.setattr(splits, "MERGE_VALUES", 50)
    most, merge = [], splits._merge

    def watched(parts):
        most.append(sum(len(memoryview(p)) // 32 for p in parts))
        return merge(parts)

    monkeypatch.setattr(splits, "_merge", watched)
    values = np.arange(20.0)
    run = splits.packed_run(values, np.ones(20), np.full(20, 2.0), values)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 100 + [1], pa.int32()), pa.array([0] * 101, pa.int32()), pa.array([run] * 101, pa.binary())],
        ["slot", "feature", "data"])
    found = list(splits._keyed([batch.slice(0, 40), batch.slice(40)], ("slot", "feature")))
    assert [k for k, _ in found] == [(0, 0), (1, 0)] and max(most) <= 100
    assert (found[0][1] == [values, np.full(20, 100), np.full(20, 200), 100 * values]).all()
    assert (found[1][1][1] == 1).all()


def test_values_of_a_chunk_are_sorted_once_for_all_passes(monkeypatch):
    rows, width = 2_000, 2
    draw = np.random.default_rng(5)
    x, y = np.round(draw.random((rows, width)), 2), (np.arange(rows) % 3 == 0).astype(np.uint8)
    x[::7, 1] = np.nan
    block = pa.RecordBatch.from_arrays(
        [pa.array([v], pa.binary()) for v in (y.tobytes(), x.tobytes(), None)], BLOCKS.names)
    coded = list(trees._coded(lambda batches: batches, width)([block]))
    nodes = trees.Nodes()
    nodes.add(0, 0)
    run = trees._level_pass(nodes.arrays(), [0], np.arange(1), [[0, 1]], None, width, trees.ClassWeights())
    raw = [b.to_pydict() for b in run([block])]
    monkeypatch.setattr(trees.np, "unique", None)
    assert [b.to_pydict() for b in run(coded)] == raw and len(raw) == width


def test_buckets_make_the_runs_once(spark):
    made, values = spark.sparkContext.accumulator(0), np.arange(20.0)

    def runs(batches):
        for batch in batches:
            made.add(1)
            for i in batch.column("id").to_pylist():
                data = [splits.packed_run(v, np.ones(10), np.ones(10), v % 20 > 12) for v in (values[:10], values[10:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(([0, 0], [0, 0], [0, 1], data), trees._RUN_KINDS)], splits.RUNS.fieldNames())

    found = splits.best_of_runs(spark.range(0, 3, 1, 3).mapInArrow(runs, splits.RUNS), bucketed=True)
    assert [(r["value"], r["left_cnt"], r["node_cnt"]) for r in found] == [(12.0, 39.0, 60.0)] and made.value == 3
