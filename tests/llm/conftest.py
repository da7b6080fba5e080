"""A hostile little table, as it is and empty."""

import pytest

DDL = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
       "spans string, `key` string, shard int, _row string, n_words string, fingerprint int")
SOME = "the quick brown fox jumps over the lazy dog and runs far away from all the other dogs of town"
ROWS = [
    (1, SOME, "en", "a"), (1, SOME, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"),
    (4, " \n\t \x0b ", "en", None), (None, SOME + " again", "en", None), (None, None, None, None),
    (5, "x" * 120_000, "en", "b"), (6, "word " * 30_000, "de", "b"), (7, "é 😀   <|endoftext|> ñ\x00", "fr", "c"),
    (8, SOME, "en", "c"), (9, "a b", "en", "c"), (10, "token = abcdef123456 mail a.b@c.de", "en", "a"),
]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    import os

    import riskloom
    from riskloom.session import ship_package

    ship_package(spark, os.path.dirname(riskloom.__file__))


def _table(spark, rows):
    more = (7, 0.5, "s", "k", 3, "r", "w", 1)
    return spark.createDataFrame([(*r, *more) for r in rows], DDL)


@pytest.fixture(scope="session")
def hostile(spark):
    return _table(spark, ROWS)


@pytest.fixture(scope="session")
def empty(spark):
    return _table(spark, [])


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def texts(spark, sf):
    """Whole texts of the smoke documents by id."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in docs}
