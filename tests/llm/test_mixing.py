import re
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import mixing


def test_targets():
    assert mixing.targets({"b": 10, "a": 100, None: 10}) == {"a": 140, "b": 20, None: 20}
    found = mixing.targets({"a": 10, "b": 1000, "c": 1000})
    assert found == {"a": 20, "b": Fraction(3015 - 20) * 2 / 3, "c": Fraction(3015 - 20) / 3}
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_tree_keeps_quotas():
    quotas = [5, 0, 1000, 37, 2, 300]
    for shards in (1, 2, 7, 16):
        split = mixing.split_quotas(quotas, shards, 3)
        assert split.sum(1).tolist() == quotas and split.min() >= 0
        assert split.sum(0).max() - split.sum(0).min() <= 5
        assert (split == mixing.split_quotas(quotas, shards, 3)).all()
    means = np.mean([mixing.split_quotas([30, 10], 4, s) for s in range(200)], axis=0)
    assert np.allclose(means, [[7.5] * 4, [2.5] * 4], atol=0.6)


def _documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, None).otherwise(
        F.col("source")))


def test_amounts_and_mix(spark, sf):
    docs = _documents(spark, sf)
    rows = mixing.amounts(docs).join(docs.select("doc_id", "source", "text"), "doc_id").toPandas()
    sizes = rows["text"].fillna("").map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert (rows["size"] == sizes).all() and (rows["taken"] <= 2 * rows["size"]).all()
    assert abs(rows.drop_duplicates("source")["target"].sum() - 1.5 * sizes.sum()) < 1e-6
    for _, group in rows.groupby("source", dropna=False):
        assert group["source_size"].iloc[0] == group["size"].sum()
        # Within half of the document at the border, and the part of a word that targets may have.
        border = group["size"].max() / 2
        assert abs(group["target"].iloc[0] - group["taken"].sum()) <= border + 1
        assert (group["taken"] % group["size"].clip(lower=1) == 0).all()
    again = mixing.amounts(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert again.equals(rows[again.columns].sort_values("doc_id").reset_index(drop=True))
    # The mixed rows have just these words, each copy is its document.
    mixed = mixing.mix(docs).select("doc_id", "text", "shard", "place").toPandas()
    mixed["words"] = mixed["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    words = mixed.groupby("doc_id")["words"].sum()
    taken = rows.set_index("doc_id")["taken"]
    assert words.reindex(taken.index, fill_value=0).equals(taken.rename("words"))
    whole = rows.set_index("doc_id")["text"]
    assert all((whole[i] or "") == (t or "") for i, t in zip(mixed["doc_id"], mixed["text"]))
    assert mixed["shard"].between(0, mixing.SHARDS - 1).all() and mixed["shard"].nunique() > 4
    assert mixed.groupby(["doc_id", "place"]).ngroups == len(mixed)


def test_shuffled_in_shards(spark, sf):
    parts = mixing.shuffled(mixing.mix(_documents(spark, sf))).withColumn("part", F.spark_partition_id()).toPandas()
    assert parts.groupby("shard")["part"].nunique().max() == 1
    for _, group in parts.groupby("part"):
        assert (group[["shard", "place"]].apply(tuple, axis=1).sort_values().values
                == group[["shard", "place"]].apply(tuple, axis=1).values).all()
