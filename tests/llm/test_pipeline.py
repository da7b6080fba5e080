import re

from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import mixing, pii
from riskloom.llm.scratch import kept_once, local_rows


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before, tables = docs.columns, docs, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = kept_once(stage(spark, docs, sf), f"test{number}")
        tables.append((before, docs))
        before = docs
        if number < 4:
            assert docs.columns == columns
    (raw, good), (_, unique), (_, masked), (_, mixed), (_, tokens) = tables
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in (raw, good, unique, masked, mixed)]
    assert ids[0] > ids[1] >= ids[2] == ids[3] >= ids[4]
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    kept = [texts[i] for i in ids[2]]
    assert len(set(kept)) == len(kept) and set(texts.values()) >= set(kept)
    for r in masked.collect():
        assert r["n_chars"] == len(r["text"]) and not pii.base_spans(r["text"])

    def words(table):
        return sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in table.collect())

    # Whole documents: every source ends within half of one from its target.
    assert 1.4 < words(mixed) / words(masked) < 1.6
    rows = tokens.collect()
    assert len(rows) == mixed.count() and all(r["intact"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_registered(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_keep_columns_with_clashing_names(spark, sf):
    names = ["_quality", "_text_hash", "_masked", "_THE_TEXT", "shard", "place", "row", "key"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).withColumns(
        {n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = kept_once(stage(spark, docs, sf), f"clash{number}")
    rows = docs.collect()
    assert rows and all(r[n] == f"{n} of {r['doc_id']}" for r in rows for n in names)


def test_tokens_are_written_with_small_batches(spark, hostile, monkeypatch):
    key, sizes, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], corpus_pipeline.kept_once
    before = spark.conf.get(key)

    def watched(df, name):
        sizes.append(spark.conf.get(key))
        return write(df, name)

    monkeypatch.setattr(corpus_pipeline, "kept_once", watched)
    docs = hostile.where("doc_id is not null")
    made = corpus_pipeline.tokens_stage(spark, docs, None)
    assert sizes == ["2m"] and spark.conf.get(key) == before
    assert made.count() == docs.count() and made.where("not intact").count() == 0


def test_all_stages_exchange_small_batches(spark, sf):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, "word " * 60_000, "a") for i in range(24)], "doc_id long, text string, source string")
    one = docs.coalesce(1).select("text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        for stage in (corpus_pipeline.near_duplicates_stage, corpus_pipeline.personal_data_stage,
                      corpus_pipeline.mixing_stage):
            spark.conf.unset(key)
            stage(spark, docs, sf)
            # A batch ends with the row that fills it.
            assert max(r["n"] for r in one.mapInArrow(sizes, "n long").collect()) < 3 << 20
        spark.conf.set(key, "1m")
        corpus_pipeline.mixing_stage(spark, docs, sf)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_rows_of_the_driver_need_no_python_workers(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    with monkeypatch.context() as patch:
        patch.setattr(type(spark.sparkContext), "parallelize", None)
        assert mixing.mix(docs).count() and mixing.amounts(docs).count() == docs.count()
        assert pii.sampled(docs).count()
        none = docs.where("doc_id < 0")
        assert not mixing.mix(none).count() and not pii.sampled(none).count()


def test_rows_of_the_driver(spark):
    rows = [("é", 2**40, [1, 2], 0.5), (None, None, None, None), ("", -1, [], 1.0)]
    ddl = "a string, b long, c array<long>, d double"
    made = local_rows(spark, rows, ddl)
    assert [tuple(r) for r in made.collect()] == rows and made.schema == spark.createDataFrame(rows, ddl).schema
    assert local_rows(spark, [], ddl).collect() == []
