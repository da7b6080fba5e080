from riskloom.llm import pii


def _prose(spark):
    """3,000 texts with years, five with a phone number, one of these copied."""
    rows = [(f"in the year {n} the town had {n * 7} people",) for n in range(3000)]
    rows += [(f"please call +1 (743) 555-{n} before noon",) for n in (1000, 2000, 3000, 4000)]
    return spark.createDataFrame(rows + [("mail jane.doe@example.edu now",)] * 30, "text string")


def test_sample_has_the_labelled_texts(spark):
    docs = _prose(spark)
    texts = [r["t"] for r in pii.sampled(docs, texts=40).collect()]
    assert sum(bool(pii.base_spans(t)) for t in texts) == 5 and len(texts) == len(set(texts)) == 15
    few = [r["t"] for r in pii.sampled(docs, texts=4).collect()]
    assert len(few) == 4 and sum(bool(pii.base_spans(t)) for t in few) == 3
    # A tagger comes of it although 40 texts by hash alone are all without spans.
    assert pii.train(docs, texts=40) is not None


def test_one_long_text_does_not_fill_the_windows():
    table = " ".join(str(n) for n in range(200_000, 240_000))
    texts = [table] + [f"in the year {n} there were {n} of them" for n in range(400)]
    texts += [f"please call +1 (743) 555-{n} before noon" for n in range(1000, 1040)] + ["mail a.b@c.de now"]
    x, y = pii.examples(texts, 300)
    assert len(x) == 300 and (y == pii._tag("email", True)).any()
    assert sum((tags == pii._tag("phone", True)).any() for tags in y) == 80  # in two spellings
    # The windows without a span come from all texts.
    assert len({tuple(row) for row in x}) > 250 and sum((row >= 97).any() for row, tags in zip(x, y) if not tags.any()) > 150
    assert len(pii.examples(texts[-1:], 300)[0]) == 2 and not len(pii.examples([], 300)[0])
