"""Every operator on nulls, empty and long texts, repeated rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

from riskloom.llm import bpe, fingerprints, jaccard, licenses, mixing, pii, quality, rules, secrets, toxicity


def _mixed(df):
    return mixing.mix(df)


OPERATORS = {
    "fingerprints": lambda df: fingerprints.fingerprints(df),
    "edits": lambda df: fingerprints.compare_with_edits(df, rows_per_bucket=2),
    "licenses": licenses.scan,
    "secrets": secrets.scan,
    "bpe": lambda df: bpe.encode(df, intact="intact"),
    "amounts": mixing.amounts,
    "quality": lambda df: quality.score(df, {}),
    "toxicity": lambda df: toxicity.score(df, {}),
    "rules": lambda df: rules.apply_policy(rules.ledger(df), "v2"),
    "pii": lambda df: pii.scan(df, None),
    "mask": lambda df: pii.mask(df, None),
    "jaccard": jaccard.join,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_row_for_row(hostile, empty, rows, name):
    found = OPERATORS[name](hostile)
    assert found.count() == len(rows)
    none = OPERATORS[name](empty)
    assert none.schema.simpleString() == found.schema.simpleString() and none.count() == 0


def test_other_columns_stay(hostile):
    scanned = secrets.scan(hostile)
    assert scanned.columns == [*hostile.columns, "secrets"]
    replaced = licenses.scan(hostile)
    assert replaced.columns.count("n_words") == 1 and dict(replaced.dtypes)["n_words"] == "bigint"
    assert {r["_row"] for r in _mixed(hostile).select("_row").collect()} == {"r"}


def test_mixed_copies(hostile, empty):
    mixed = _mixed(hostile)
    assert mixed.columns == [c for c in hostile.columns if c != "shard"] + ["shard", "place"]
    assert mixed.count() > 0 and _mixed(empty).count() == 0


def test_one_of_each(hostile, empty):
    kept = jaccard.one_of_each(hostile)
    assert kept.columns == hostile.columns and jaccard.one_of_each(empty).count() == 0
    # Texts without words stay; of the three equal texts and the near one the null id stays.
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    assert ids == sorted(["2", "3", "4", "None", "None", "5", "6", "7", "9", "10"])


def test_classes_of_equal_rows(hostile):
    found = {(r["doc_id"], r["n_links"]) for r in jaccard.join(hostile).where("class_id = 1").collect()}
    assert found == {(1, 3), (8, 3), (None, 3)}


def test_null_text_is_masked_null(hostile):
    masked = {r["doc_id"]: r["text"] for r in pii.mask(hostile, None).where("doc_id in (2, 10)").collect()}
    assert masked == {2: None, 10: "token = abcdef123456 mail <email>"}


def test_training_without_labels(hostile, spark):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.train(hostile, labels, F.lit(True)) == {}
    assert toxicity.train(hostile, labels.limit(0), F.lit(True)) == {}
