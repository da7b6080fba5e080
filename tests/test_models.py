import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from riskloom.models import boosting, compare, forest, logistic, naive_bayes, splits, trees
from riskloom.models.base import shares
from riskloom.schemas import FEATURES, LABEL, LEAKAGE_FREE_FEATURES


@pytest.fixture(scope="module")
def arrays(dataset):
    pdf = dataset.orderBy("customer_id").toPandas()
    return pdf[LEAKAGE_FREE_FEATURES].to_numpy(), pdf[LABEL].to_numpy(), pdf["customer_id"].to_numpy()


def nested(nodes, at=0):
    if nodes.feature[at] < 0:
        return nodes.probability[at]
    return (nodes.feature[at], nodes.threshold[at], nested(nodes, nodes.left[at]), nested(nodes, nodes.right[at]))


def same_tree(a, b):
    if not isinstance(a, tuple) or not isinstance(b, tuple):
        assert a == pytest.approx(b, abs=1e-9)
        return
    assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-12)
    same_tree(a[2], b[2])
    same_tree(a[3], b[3])


def test_tree_equals_brute_force(dataset, arrays):
    x, y, _ = arrays
    model = trees.fit_tree(dataset, 4, 10, names=LEAKAGE_FREE_FEATURES)
    want = brute.tree(x, y, np.ones(len(y)), np.ones(len(y)), 0, 4, 10, range(x.shape[1]))
    same_tree(nested(model.nodes), want)
    got = model.transform(dataset).orderBy("customer_id").select("probability_of_default").toPandas().iloc[:, 0]
    assert got.to_numpy() == pytest.approx([brute.predict(want, r) for r in x])


def test_weighted_tree_mixes_impurity_by_rows(dataset, arrays):
    x, y, _ = arrays
    model = trees.fit_tree(dataset, 3, 10, trees.ClassWeights(3.0, 0.5), LEAKAGE_FREE_FEATURES)
    want = brute.tree(x, y, np.where(y == 1, 3.0, 0.5), np.ones(len(y)), 0, 3, 10, range(x.shape[1]))
    same_tree(nested(model.nodes), want)


def test_forest_equals_brute_force(dataset, arrays):
    x, y, ids = arrays
    seed, n_trees = 5, 6
    model = forest.fit_random_forest(dataset, n_trees, 4, 10, seed, LEAKAGE_FREE_FEATURES)
    draws = forest.bootstrap_weights(dataset, n_trees, seed).toPandas()
    subsets = forest.feature_subsets(x.shape[1], n_trees, seed)
    n_pos = y.sum()
    w = np.where(y == 1, len(y) / (2 * n_pos), len(y) / (2 * (len(y) - n_pos)))
    for t in range(n_trees):
        mine = draws[draws["tree"] == t].set_index("customer_id")["draws"]
        n = np.array([mine.get(i, 0) for i in ids], dtype=float)
        keep = n > 0
        want = brute.tree(x[keep], y[keep], w[keep], n[keep], 0, 4, 10, subsets[t])
        same_tree(nested(model.nodes, model.nodes.roots[t]), want)
    assert sum(model.importances()) == pytest.approx(1.0)
    table = model.node_table(dataset.sparkSession)
    counts = {r.feature: r["count"] for r in table.where("feature is not null").groupBy("feature").count().collect()}
    total = sum(counts.values())
    assert model.importances() == pytest.approx([counts.get(f, 0) / total for f in LEAKAGE_FREE_FEATURES])


def test_boosting_equals_brute_force(dataset, arrays):
    x, y, _ = arrays
    model = boosting.fit_boosting(dataset, 4, 0.1, 3, 15, LEAKAGE_FREE_FEATURES)
    want, p = brute.boosted(x, y, 4, 0.1, 3, 15)
    for root, tree in zip(model.nodes.roots, want):
        same_tree(nested(model.nodes, root), tree)
    got = model.transform(dataset).orderBy("customer_id").select("probability_of_default").toPandas().iloc[:, 0]
    assert got.to_numpy() == pytest.approx(p, abs=1e-9)
    assert model.importances() == [1 / x.shape[1]] * x.shape[1]


def test_logistic_equals_brute_force(dataset, arrays):
    x, y, _ = arrays
    model = logistic.fit_logistic(dataset, 0.05, 12, 0.001, LEAKAGE_FREE_FEATURES)
    w, b = brute.logistic(x, y, 0.05, 12, 0.001)
    assert model.weights == pytest.approx(w, abs=1e-9) and model.bias == pytest.approx(b, abs=1e-9)
    assert sum(model.importances()) == pytest.approx(1.0)


def test_results_do_not_depend_on_partitioning(spark, dataset, monkeypatch):
    monkeypatch.setattr("riskloom.models.base.ROWS_PER_TASK", 20)
    spread = dataset.repartition(6, "customer_id")
    for fit in (
        lambda d: forest.fit_random_forest(d, 3, 3, names=LEAKAGE_FREE_FEATURES).nodes.threshold,
        lambda d: logistic.fit_logistic(d, epochs=3, names=LEAKAGE_FREE_FEATURES).weights,
    ):
        a = fit(spread)
        monkeypatch.setattr("riskloom.models.base.ROWS_PER_TASK", 10**6)
        assert a == pytest.approx(fit(dataset), abs=1e-9)
        monkeypatch.setattr("riskloom.models.base.ROWS_PER_TASK", 20)


def test_buckets_change_no_tree(dataset):
    one = trees.fit_tree(dataset, 3, 10, names=LEAKAGE_FREE_FEATURES)
    many = trees.fit_tree(dataset, 3, 10, names=LEAKAGE_FREE_FEATURES, rows_per_bucket=20)
    assert nested(many.nodes) == nested(one.nodes)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 4_000])
def test_many_distinct_values_are_searched_exactly(spark, rows_per_bucket):
    rows = 40_000
    df = spark.range(rows).select(
        F.col("id").alias("customer_id"), (F.xxhash64("id") / 2.0**40).alias("a"), (F.col("id") % 7).cast("double").alias("b"),
    ).withColumn("is_default", ((F.sin(F.col("a") / 1e6) + F.col("b") / 9 + F.rand(3)) > 1).cast("int"))
    model = trees.fit_tree(df, 3, 10, names=["a", "b"], rows_per_bucket=rows_per_bucket)
    data = df.toPandas()
    x, y = data[["a", "b"]].to_numpy(), data["is_default"].to_numpy().astype(float)
    ones = np.ones(len(y))
    assert nested(model.nodes) == brute.tree(x, y, ones, ones, 0, 3, 10, [0, 1])
    best = splits.best_split(df.withColumnRenamed("is_default", "y"), ["a", "b"], rows_per_bucket=rows_per_bucket).first()
    assert (["a", "b"].index(best.feature), best.threshold) == nested(model.nodes)[:2]


@pytest.mark.parametrize("distinct,expected", [(1, 0), (15, 14), (29, 28), (30, 15), (31, 15)])
def test_candidate_stepping(spark, distinct, expected):
    """L values give every max(L div 15, 1)-th; the last value never splits."""
    stats = spark.range(distinct).select(
        F.lit(0).alias("feature"), F.col("id").cast("double").alias("value"), F.lit(1).alias("cnt"),
        F.lit(1.0).alias("wgt"), (F.col("id") % 2).cast("double").alias("pos"))
    gains = splits.split_gains(splits.split_candidates(stats, []))
    assert gains.where("gain > -1").count() == expected


def test_equal_gain_takes_first_feature_and_lowest_threshold(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 1.0, 0), (2.0, 2.0, 1), (2.0, 2.0, 1)], "a double, b double, y int")
    assert splits.best_split(df, ["b", "a"]).first().feature == "b"
    row = splits.best_split(df, ["a", "b"]).first()
    assert (row.feature, row.threshold, row.left_rows, row.node_rows) == ("a", 1.0, 2, 4)
    assert splits.best_split(df.where("y = 1"), ["a"]).isEmpty()


def test_naive_bayes_needs_both_classes(dataset):
    with pytest.raises(ValueError):
        naive_bayes.fit_naive_bayes(dataset.where(f"{LABEL} = 1"))


def test_empty_training_table(dataset):
    with pytest.raises(ValueError):
        forest.fit_random_forest(dataset.where("customer_id < 0"))


def test_constant_features_give_a_leaf(spark):
    df = spark.createDataFrame([(i, 1.0, float(i % 2)) for i in range(20)], f"customer_id long, a double, {LABEL} double")
    model = trees.fit_tree(df, names=["a"])
    assert nested(model.nodes) == 0.5 and model.nodes.samples == [20]
    assert model.importances() == [1.0]


def test_forest_defaults():
    subsets = forest.feature_subsets(15, 25, 1)
    assert len(subsets) == 25 and all(len(set(s)) == 4 for s in subsets)
    assert len(forest.feature_subsets(1, 1, 1)[0]) == 1
    assert shares([0, 0]) == [0.5, 0.5]


def test_bootstrap_is_poisson_and_seeded(spark):
    df = spark.range(20000).withColumnRenamed("id", "customer_id")
    draws = forest.bootstrap_weights(df, 2, 1)
    per_tree = draws.groupBy("tree").agg(F.sum("draws").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    for r in per_tree:
        assert abs(r.n / 20000 - 1) < 0.05 and abs(r.rows / 20000 - (1 - np.exp(-1))) < 0.02
    assert draws.exceptAll(forest.bootstrap_weights(df.repartition(3), 2, 1)).isEmpty()


def test_boosting_never_predicts_default_on_rare_labels(spark):
    """20 rounds of 0.1 move the log odds by 2 at most: from 1.7 % nothing reaches one half."""
    df = spark.range(1200).select(F.col("id").alias("customer_id"), (F.col("id") % 60).cast("double").alias("a"),
                                  (F.col("id") % 60 == 0).cast("double").alias(LABEL))
    model = boosting.fit_boosting(df, names=["a"], depth=2)
    assert model.predict(df).where("prediction = 1").isEmpty()


def test_compare_models(dataset):
    result = compare.compare_models(dataset, 3)
    rows = result.metrics.collect()
    assert [r.model_name for r in rows] == [compare.LOGISTIC, compare.BAYES, compare.FOREST, compare.BOOSTING]
    assert len({r.total_samples for r in rows}) == 1
    assert result.champion.name == "Random Forest"
    assert all(r.roc_auc > 0.9 for r in rows if r.model_name != compare.LOGISTIC)


def test_forest_is_as_good_as_the_library(dataset):
    """Quality only: the library draws features per node and bins thresholds, so trees differ."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from riskloom.operators.metrics import roc_auc

    train = VectorAssembler(inputCols=LEAKAGE_FREE_FEATURES, outputCol="v").transform(dataset)
    library = RandomForestClassifier(featuresCol="v", labelCol=LABEL, numTrees=10, maxDepth=5, seed=1).fit(train)
    theirs = library.transform(train).select(
        F.col(LABEL).alias("y"), vector_to_array("probability")[1].alias("p"))
    ours = forest.fit_random_forest(dataset, 10, 5, names=LEAKAGE_FREE_FEATURES).transform(dataset, "p").select(
        F.col(LABEL).alias("y"), "p")
    assert roc_auc(ours).first()[0] > roc_auc(theirs).first()[0] - 0.08


def test_cuts_of_all_features_at_once(spark, monkeypatch):
    """More buckets than a grid has points come from its parts; few values or rows need no cuts."""
    df = spark.range(3_000).select(F.posexplode(F.array(
        F.col("id").cast("double"), (F.col("id") % 4).cast("double"), (F.col("id") / 7))).alias("feature", "value"))
    assert splits.value_cuts(df, 3, 3_000) is None
    plain = splits.value_cuts(df, 3, 300)
    assert [len(c) for c in plain][::2] == [9, 9] and set(plain[1]) <= {0.0, 1.0, 2.0, 3.0}
    monkeypatch.setattr(splits, "GRID", 8)
    finer = splits.value_cuts(df, 3, 100)
    for cuts in (finer[0], finer[2]):
        places = np.searchsorted(cuts, np.arange(3_000.0) / (7 if cuts is finer[2] else 1))
        assert cuts == sorted(cuts) and np.bincount(places).max() <= 250


def test_one_task_and_jobs_take_the_same_steps(dataset, monkeypatch):
    monkeypatch.setattr("riskloom.models.base.ROWS_PER_TASK", 20)
    spread = dataset.repartition(5, "customer_id")
    fit = lambda held: logistic.fit_logistic(spread, epochs=7, names=LEAKAGE_FREE_FEATURES, held_rows=held)
    together, by_jobs = fit(10**6), fit(0)
    assert together.weights == pytest.approx(by_jobs.weights, abs=1e-12)
    assert together.bias == pytest.approx(by_jobs.bias, abs=1e-12)
    monkeypatch.setattr(logistic, "MAX_PARTIALS", 1)
    assert fit(0).weights == pytest.approx(by_jobs.weights, abs=1e-12)
