import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import quality, sampling, toxicity


def _auc(scores, y):
    rank = np.empty(len(scores))
    rank[np.argsort(scores, kind="stable")] = np.arange(1, len(scores) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / n / (len(y) - n)


def _held_out(spark, label, parts, held, train, score):
    """AUC on the fold that no label was learnt from."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    weights = train(docs, labels, sampling.fold(labels["doc_id"], parts) != held)
    rows = score(docs, weights).join(labels, "doc_id").where(
        sampling.fold(F.col("doc_id"), parts) == held).select("score", label).toPandas()
    assert rows["score"].between(0, 1).all()
    return rows["score"].to_numpy(), rows[label].to_numpy()


def test_quality_held_out(spark):
    scores, y = _held_out(spark, "quality", 3, 1, quality.train, quality.score)
    assert _auc(scores, y) > 0.97
    assert (scores[y == 1] >= 0.5).mean() > 0.97 and (scores[y == 0] < 0.5).mean() > 0.8


def test_toxicity_held_out(spark):
    scores, y = _held_out(spark, "toxic", 5, 0, toxicity.train, toxicity.score)
    assert _auc(scores, y) > 0.93
    assert (scores[y == 0] < 0.5).mean() > 0.98 and (scores[y == 1] >= 0.5).mean() > 0.7


def test_chunks_cover_whole_texts():
    edges = np.array([0, 0, 10, 266, 1000, 9000])
    owner, start, end = quality.chunk_ranges(edges)
    for text, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        mine = np.flatnonzero(owner == text)
        assert start[mine[0]] == a and end[mine[-1]] == b
        assert all(start[j] < end[i] for i, j in zip(mine, mine[1:]))


def test_blocks_do_not_change_scores(texts):
    values = [*texts.values()][:60]
    for network in (quality.Network(), toxicity.Network()):
        together = network.scores(pa.array(values))
        alone = np.array([network.scores(pa.array([v]))[0] for v in values])
        assert np.allclose(together, alone, atol=1e-5)


def test_quality_gradients():
    network = quality.Network(seed=3)
    network.w = {n: w.astype(np.float64) for n, w in network.w.items()}
    draw = np.random.default_rng(2)
    rows = draw.integers(0, 256, (5, quality.CHUNK)).astype(np.int16)
    owner, sizes = np.array([0, 0, 1, 2, 2]), np.array([400, 200, 300])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        z = network.combine(network.pool(rows), owner, sizes)
        return ((np.logaddexp(0, z) - y * z) * weight).sum() / weight.sum()

    grads = network.gradients(rows, owner, sizes, y, weight)
    for name in ("out", "hidden", "filters", "bias", "bytes"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept = network.w[name][at]
        network.w[name][at] = kept + 1e-3
        high = loss()
        network.w[name][at] = kept - 1e-3
        low = loss()
        network.w[name][at] = kept
        assert abs((high - low) / 2e-3 - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-4, name


def test_words_are_hashed_alike_everywhere():
    texts = pa.array(["The cat", "cat", "", "the CAT's cat", "été"])
    rows, edges = toxicity.hashed_words(*toxicity.flat(texts))
    assert np.diff(edges).tolist() == [2, 1, 0, 4, 1]
    assert (rows[1] == rows[2]).all() and (rows[0] == rows[3]).all() and (rows[4] == rows[1]).all()


def test_languages():
    texts = pa.array(["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", ""])
    words, edges = toxicity.hashed_words(*toxicity.flat(texts))
    assert toxicity.languages(words, edges).tolist() == [0, 1, 2, 3, 0]


def test_thresholds_separate():
    draw = np.random.default_rng(0)
    y = (np.arange(400) % 2).astype(float)
    z = np.where(y == 1, 3.0, 1.0) + draw.normal(0, 0.1, 400)
    found = toxicity.thresholds(z, y, np.ones(400), np.where(np.arange(400) < 300, 1, 2))
    assert np.allclose(found[:3], 2.0, atol=0.4)


def test_sample_is_bounded(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("quality"))
    rows = sampling.labelled_sample(docs.union(docs), labels.union(labels), "quality", F.lit(True), 40).collect()
    assert len(rows) == 80 and {(r["y"], r["weight"]) for r in rows} == {(0, 10.0), (1, 2.5)}
