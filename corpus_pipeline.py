"""Documents to training tokens in five stages, each written as Parquet and read again.

Quality classifier, n-gram Jaccard join, personal data, mixing of sources, byte-level BPE. Each
stage works on all rows of the one before; all but the last return the columns of documents.
"""

import os

from pyspark.sql import functions as F

import riskloom
from riskloom.llm import bpe, jaccard, mixing, pii, quality, queries
from riskloom.llm.blocks import unused
from riskloom.llm.scratch import kept_once, small_batches, small_batches_from_now
from riskloom.session import ship_package


def _shipped(spark):
    """Functions in tasks need the package on the executors."""
    ship_package(spark, os.path.dirname(riskloom.__file__))


def _ready(spark):
    """For stages whose tables are computed when they are read: batches of whole texts stay small then
    too, as 64 MB of them, held several times on either side, stay with the executors afterwards."""
    _shipped(spark)
    small_batches_from_now(spark)


def _with_length(docs):
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_stage(spark, docs, sf_dir):
    """Documents whose quality score is below 0.5 go; null texts are scored as empty ones.

    Repeated rows get equal scores; an empty table stays empty. In this stage as in the next three
    the columns of the documents stay as they are, whatever further ones are called.
    """
    _ready(spark)
    column = unused(docs, "_quality")
    scored = quality.score(docs, queries.quality_weights(spark, sf_dir, docs), column=column)
    return scored.filter(F.col(column) >= 0.5).select(*docs.columns)


def near_duplicates_stage(spark, docs, sf_dir):
    """Of each class of linked documents the one with the least id stays.

    A null id comes before others. Rows that repeat id and text are one document; texts without words,
    null ones included, are linked to none and all stay.
    """
    _ready(spark)
    return jaccard.one_of_each(docs)


def personal_data_stage(spark, docs, sf_dir):
    """Personal data are replaced by their kind; a null text stays null, with a null length."""
    _ready(spark)
    return _with_length(pii.mask(docs, pii.train(docs))).select(*docs.columns)


def mixing_stage(spark, docs, sf_dir):
    """A row for each copy that the mix takes, in shuffled shards; documents it does not take go.

    Texts are whole. Null and empty texts have no words, so a mix by words takes a copy of them only
    where a source is taken whole. Repeated rows are mixed as rows of their own.
    """
    _ready(spark)
    names = {"shard": unused(docs, "shard"), "place": unused(docs, "place")}
    mixed = mixing.shuffled(mixing.mix(docs, shards=None, **names), **names)
    return _with_length(mixed).select(*docs.columns)


def tokens_stage(spark, docs, sf_dir):
    """Token ids of each row, their number, and whether they decode to the same text; a null or empty
    text has none. Other columns go.

    Executors come here with full heaps, so the table is written with small batches to and from Python.
    """
    _shipped(spark)
    made = bpe.encode(docs.select("doc_id", "lang", "source", "text"), intact="intact").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "intact")
    with small_batches(spark):
        return kept_once(made, "tokens")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("personal data", personal_data_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding", tokens_stage),
]
#: Trained models and similarity classes have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; returns the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = kept_once(docs, f"stage{number + 1}")
    return docs
