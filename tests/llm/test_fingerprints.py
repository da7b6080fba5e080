import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st

from riskloom.llm import fingerprints as P


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_common_subsequence_is_exact():
    draw = np.random.default_rng(0)
    a, b = draw.integers(0, 9, (60, 64)).astype(np.int16), draw.integers(0, 9, (60, 64)).astype(np.int16)
    a[:20, 40:] = -1
    b[10:30, 7:] = -1
    wanted = [_lcs([x for x in p if x >= 0], [x for x in q if x >= 0]) for p, q in zip(a, b)]
    assert P.common(a, b).tolist() == wanted


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=300), min_size=1, max_size=6))
def test_blocks_do_not_matter(texts):
    together = P.written(*P._arrays(texts))
    assert together == [P.written(*P._arrays([t]))[0] for t in texts]
    parsed = P.parsed(together)
    assert P.likeness(parsed, parsed).tolist() == [1.0] * len(texts)
    assert all(len(part) <= 2 * P.LONGEST for print_ in together for part in print_.split(":")[1:])


def test_edits_against_brute_force(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    order = sorted(texts, reverse=True)
    for size in (7, 10_000):
        found = {r["doc_id"]: r for r in P.compare_with_edits(docs, rows_per_bucket=size).collect()}
        assert sorted(found) == sorted(texts)
        for here, after in zip(order, order[1:] + order[:1]):
            text, k = texts[here], len(texts[here]) // 3
            edited, row = text[:len(text) - k] + texts[after][:k], found[here]
            one, two, three = (P._arrays([t]) for t in (text, edited, texts[after]))
            assert row["n_chars"] == len(text)
            assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert [row["fingerprint"], row["edited_fingerprint"]] == [P.written(*one)[0], P.written(*two)[0]]
            assert [row["near_edited"], row["near_next"]] == [P.likeness(one, two)[0], P.likeness(one, three)[0]]
        near = np.array([r["near_edited"] for r in found.values()])
        assert np.median(near) > 0.5 > np.median([r["near_next"] for r in found.values()])


def test_similarity_of_columns(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = P.fingerprints(spark.createDataFrame([(0, text), (1, text[300:]), (2, None)], "id int, text string"))
    one, two, none = [r["fingerprint"] for r in rows.orderBy("id").collect()]
    pairs = spark.createDataFrame([(one, one), (one, two), (one, none), (none, none), (one, None)], "a string, b string")
    found = [r[0] for r in pairs.select(P.similarity(pairs["a"], pairs["b"])).collect()]
    assert found[0] == 1 and 0.5 < found[1] < 1 and found[2:4] == [0, 1] and found[4] is None
