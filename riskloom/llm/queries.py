"""Registered queries of the subpackage; each takes (spark, folder of the tables)."""

from pyspark.sql import functions as F

from riskloom.llm import alignment, bpe, fingerprints, jaccard, licenses, mixing, negatives, pii, quality, rules, sampling, secrets, sharding, spans, toxicity


def _documents(spark, sf_dir, *columns):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def op1_fingerprints(spark, sf_dir):
    """Fingerprint of every text and of its edited text, with the likeness to these and to the next
    document; null texts are empty ones, null ids come last in the order of documents."""
    return fingerprints.compare_with_edits(_documents(spark, sf_dir, "doc_id", "text"))


def op2_license_scan(spark, sf_dir):
    """Licence phrases and notices of every text. Null and empty texts have no words, spans or labels
    and a score of 0; the score falls with the errors of the best span."""
    found = licenses.scan(_documents(spark, sf_dir, "doc_id", "text"), drop=["text"])
    places = F.transform("phrases", lambda s: s["first_word"])
    both = F.concat("phrases", "notices")

    def labels(spans_):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans_, lambda s: s["label"]))), ",")

    fits = F.transform(both, lambda s: 1.0 / (1.0 + s["errors"] / 4.0))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(F.col("phrases")).alias("base_labels"), labels(both).alias("labels"),
        F.coalesce(F.array_max(fits), F.lit(0.0)).alias("score"),
        F.array_join(F.transform("notices", lambda s: F.concat_ws(
            ":", s["label"], s["first_word"].cast("string"), s["last_word"].cast("string"),
            s["errors"].cast("string"))), ",").alias("notices"))


def op3_secret_scan(spark, sf_dir):
    """Secrets of every text: the fixed patterns and novel strings. Null and empty texts have none."""
    found = secrets.scan(_documents(spark, sf_dir, "doc_id", "text"), drop=["text"])
    base = spans.of_kinds(F.col("secrets"), secrets.KINDS[:3])
    return found.select(
        "doc_id", *[spans.count_kind(F.col("secrets"), k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(spans.as_text(base), 256).alias("base_sha256"),
        spans.as_text(F.col("secrets")).alias("spans"))


def op4_bpe(spark, sf_dir):
    """Token ids of every text and the text they decode to, as digests; null texts are empty ones."""
    return bpe.digests(_documents(spark, sf_dir, "doc_id", "text"))


def op5_mixing(spark, sf_dir):
    """Words of every document that a mix of all sources takes: whole copies of it, none or up to two.
    Null texts have no words; a null source is a source of its own."""
    return mixing.amounts(_documents(spark, sf_dir, "doc_id", "source", "text"))


def _predictions(scored, held_out_fold):
    """The columns of a classifier's query; a null id belongs to no fold."""
    return scored.select(
        "doc_id", F.coalesce(held_out_fold, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_weights(spark, sf_dir, docs):
    """Learnt from the label rows outside the held-out fold."""
    labels = _labels(spark, sf_dir)
    return quality.train(docs, labels, sampling.fold(labels["doc_id"], 3) != 1)


def op6_quality_classifier(spark, sf_dir):
    """Quality score of every text; null and empty texts are scored as empty ones."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    scored = quality.score(docs, quality_weights(spark, sf_dir, docs), drop=["text"])
    return _predictions(scored, sampling.fold(F.col("doc_id"), 3) == 1)


def op7_toxicity(spark, sf_dir):
    """Toxicity score of every text, 0.5 being the threshold of its language; null texts as empty ones."""
    docs, labels = _documents(spark, sf_dir, "doc_id", "text"), _labels(spark, sf_dir)
    weights = toxicity.train(docs, labels, sampling.fold(labels["doc_id"], 5) != 0)
    scored = toxicity.score(docs, weights, drop=["text"])
    return _predictions(scored, sampling.fold(F.col("doc_id"), 5) == 0)


def op8_quality_rules(spark, sf_dir):
    """Measures and failed rules of every text under policy v2; null and empty texts have no words
    and fail the base rules."""
    rows = rules.apply_policy(rules.ledger(_documents(spark, sf_dir, "doc_id", "text")), "v2")
    base = rules.mask(rules.BASE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept", "failures")


def op9_pii(spark, sf_dir):
    """Personal data of every text: the fixed patterns and the tagger's spans. Null and empty texts
    have none. ``n_spans`` counts all spans."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    found = pii.scan(docs, pii.train(docs), drop=["text"])
    base = F.filter("personal", lambda s: s["base"])
    return found.select(
        "doc_id", *[spans.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(spans.as_text(base), 256).alias("base_sha256"),
        spans.as_text(F.col("personal")).alias("spans"), F.size("personal").cast("long").alias("n_spans"))


def op10_jaccard_join(spark, sf_dir):
    """Class and number of links of every document; one without words is a class of its own."""
    return jaccard.join(_documents(spark, sf_dir, "doc_id", "text"))


def op11_hard_negatives(spark, sf_dir):
    """Labels of ids divisible by 7 move on by one; anchors are the ids divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    id_, label = F.col("vec_id"), F.col("label")
    moved = rows.select("vec_id", "embedding", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return negatives.mine(moved, moved["vec_id"] % 100 == 0)


def op12_sharding(spark, sf_dir):
    """Forty shards of near equal bytes; adding a shard moves rows anywhere, so ``grown_shard`` is null."""
    placed = sharding.place(_documents(spark, sf_dir, "doc_id", "text"), 40, keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op13_token_alignment(spark, sf_dir):
    """Alignment of the byte-level and the piece tokenizer, with link counts of the whole table."""
    return alignment.align(_documents(spark, sf_dir, "doc_id", "text"), keep=["doc_id"])


REGISTRY = {
    "op1_fingerprints": op1_fingerprints,
    "op2_license_scan": op2_license_scan,
    "op3_secret_scan": op3_secret_scan,
    "op4_bpe": op4_bpe,
    "op5_mixing": op5_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_pii": op9_pii,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sharding": op12_sharding,
    "op13_token_alignment": op13_token_alignment,
}
