"""Fits see every labelled row, and the way the rows are dealt changes nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality, toxicity
from riskloom.llm.rounds import Rows, _likely

SIZE = 700


@pytest.fixture(autouse=True)
def short(monkeypatch):
    monkeypatch.setattr("riskloom.llm.rounds.ROUND_STEPS", 4)
    monkeypatch.setattr("riskloom.llm.rounds.ROUNDS", 2)


def _tables(spark):
    """Texts name their place; one is null, one is long, one stands twice; ids are labelled twice."""
    id_ = F.col("id")
    docs = spark.range(SIZE).select(id_.alias("doc_id"), F.when(id_ == 0, None).when(
        id_ == 1, F.concat(F.lit("1 "), F.repeat(F.lit("word "), 30_000))).otherwise(
            F.concat(id_.cast("string"), F.lit(" "))).alias("text"))
    docs = docs.union(docs.where("doc_id = 2"))
    labels = docs.select("doc_id", (F.col("doc_id") % 7 == 0).cast("int").alias("toxic")).union(
        docs.where("doc_id = 3").select("doc_id", F.lit(1))).withColumn("quality", F.col("toxic"))
    return docs, labels


def _marks(size):
    """Gradients that count how often the text of each place is learnt from; the null text is the last."""
    def start(weights):
        def block(data, edges):
            names = [bytes(data[a:b]).split(b" ")[0] for a, b in zip(edges[:-1], edges[1:])]
            places = np.array([int(n) if n else size for n in names])

            def step(picked, y):
                return {"hits": -np.bincount(places[picked], minlength=size + 1).astype(np.float32),
                        "positive": -np.bincount(places[picked], y, size + 1).astype(np.float32)}

            return step

        return block

    return start


def test_every_labelled_row_is_learnt_from(spark):
    docs, labels = _tables(spark)
    start = {n: np.zeros(SIZE + 1, np.float32) for n in ("hits", "positive")}
    for part_rows in (50, SIZE):
        with Rows(docs, labels, "toxic", F.lit(True), quality.prepared, part_rows=part_rows) as table:
            assert len(table) == table.fitted() == SIZE and table.fitted(1) == 1 + len(range(0, SIZE, 7))
            made = table.fit(start, _marks(SIZE), 16, 0.01, seed=1, rounds=1)
        assert np.flatnonzero(made["hits"]).tolist() == list(range(1, SIZE + 1))
        assert set(np.flatnonzero(made["positive"])) == {3, SIZE, *range(7, SIZE, 7)}


def test_counts_of_the_fitted_rows(spark):
    docs, labels = _tables(spark)
    with Rows(docs, labels, "toxic", F.lit(True), quality.prepared, apart=5, part_rows=50) as table:
        total = table.summed(lambda data, edges: np.array([len(edges) - 1, 1]), 2)
        assert len(table) == SIZE and 0 < table.fitted() < SIZE and total[0] == table.fitted()


@pytest.mark.parametrize("train", [toxicity.train, quality.train])
def test_long_texts_are_learnt_from(spark, train):
    docs, labels = _tables(spark)
    only = labels.where("doc_id = 1").withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(1))
    assert train(docs, only, F.lit(True)) and not train(docs, only, F.lit(False))


@pytest.mark.parametrize("train", [toxicity.train, quality.train])
def test_the_deal_changes_no_weight(spark, train, monkeypatch):
    monkeypatch.setattr(Rows.__init__, "__defaults__", (0, 100))
    docs, labels = _tables(spark)
    found = []
    for tasks in (3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        found.append(train(docs.repartition(tasks), labels, F.lit(True)))
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    assert all((found[0][n] == found[1][n]).all() for n in found[0])


def test_labelled_texts_are_shuffled_once_whatever_the_plan(spark):
    """No join moves texts: with and without a broadcast of the labels the volume is that of the labelled."""
    docs, labels = _tables(spark)
    more = docs.union(spark.range(SIZE, 40 * SIZE).select("id", F.lit("no label").alias("text")))
    before, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    try:
        for limit in ("-1", "1g"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            with Rows(more, labels, "toxic", F.lit(True), quality.prepared, part_rows=50) as table:
                found.append(sorted(map(tuple, table.table.select("part", "y", "data").collect())))
                plan = table.table._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" not in plan
                assert plan.split("Initial Plan")[-1].count("REPARTITION_BY_NUM") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1] and len(found[0]) == SIZE


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])
def test_texts_without_a_label_are_left_out_where_they_are_read(spark, monkeypatch, bits):
    monkeypatch.setattr("riskloom.llm.rounds.LEAST_BITS", bits)
    monkeypatch.setattr("riskloom.llm.rounds.MOST_BITS", bits)
    docs = spark.range(-5_000, 5_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).union(
        spark.createDataFrame([(None, "t")], "doc_id long, text string"))
    known = docs.where("doc_id % 10 = 0")
    kept = _likely(docs, known, 1_000)
    assert kept.columns == docs.columns and not kept.where("doc_id is null").count()
    assert kept.where("doc_id % 10 = 0").count() == 1_000 and kept.count() < 1_000 + 9_000 * 2 * 1_000 / bits + 5
