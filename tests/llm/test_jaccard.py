import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import components, jaccard, shingles


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _brute(texts):
    sets, links, root = {i: _set(t) for i, t in texts.items()}, collections.Counter(), {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    for i, s in sets.items():
        common = collections.Counter(j for shingle in s for j in holders[shingle])
        for j, n in common.items():
            if j != i and 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in texts}


def _near_copies(n, seed, words=80, edits=3):
    draw = np.random.default_rng(seed)
    base = [f"w{draw.integers(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        mine = list(base)
        for at in draw.integers(0, words, draw.integers(0, edits)):
            mine[at] = f"x{draw.integers(10 ** 6)}"
        out.append(" ".join(mine))
    return out


def _check(spark, texts):
    df = spark.createDataFrame([(int(i), t) for i, t in texts.items()], "doc_id long, text string")
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(df).collect()}
    assert found == _brute(texts)


def test_smoke_documents(spark, texts):
    _check(spark, texts)


@pytest.mark.parametrize("small", [256, 6])
def test_copies_and_common_passages(spark, monkeypatch, small):
    """Large groups of near copies, and passages that unlike texts share: splits and blocks."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    monkeypatch.setattr(jaccard, "EXACT_ROWS", 30)
    draw = np.random.default_rng(4)
    values = _near_copies(120, 1) + _near_copies(30, 2, words=25) + ["few words", "few words", "", " "]
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(60):
        own = " ".join(f"o{draw.integers(10 ** 6)}" for _ in range(draw.integers(20, 60)))
        values += [own + " " + passage, passage + " " + own]
    _check(spark, dict(enumerate(values)))


def test_sets_do_not_depend_on_blocks(texts):
    values = [*texts.values()]
    hashes, edges = shingles.shingle_sets(*jaccard.flat(pa.array(values)))
    for text, a, b in zip(values, edges[:-1], edges[1:]):
        alone, _ = shingles.shingle_sets(*jaccard.flat(pa.array([text])))
        assert (hashes[a:b] == alone).all() and b - a == len(_set(text))


def test_minhashes_estimate():
    draw = np.random.default_rng(1)
    common = draw.integers(0, 1 << 63, 900).astype(np.uint64)
    sides = [np.unique(np.r_[common, draw.integers(0, 1 << 63, 100).astype(np.uint64)]) for _ in range(2)]
    hashes = shingles.minhashes(np.concatenate(sides), np.array([0, len(sides[0]), len(sides[0]) + len(sides[1])]), 512)
    assert abs((hashes[0] == hashes[1]).mean() - 900 / 1100) < 0.06


def test_forest_spans():
    draw = np.random.default_rng(3)
    for same in (True, False):
        matrix = draw.random((30, 30)) < 0.05
        if same:
            matrix = (matrix | matrix.T) & ~np.eye(30, dtype=bool)
        shift = 0 if same else 30
        adjacency = np.zeros((30 + shift, 30 + shift), bool)
        adjacency[:30, shift:] |= matrix
        reach = [np.linalg.matrix_power((m | m.T).astype(float) + np.eye(len(m)), 60) > 0 for m in (
            adjacency, _of(jaccard.forest(matrix, same), 30, shift))]
        assert (reach[0] == reach[1]).all()


def _of(links, n, shift):
    out = np.zeros((n + shift, n + shift), bool)
    for a, b in links:
        assert a < n and b < n
        out[a, b + shift] = True
    return out


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (7, 7), (300, 300)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components.components(edges.limit(0)).count() == 0


def test_one_of_each_with_repeated_rows_and_clashing_names(spark, monkeypatch):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "", "z"), (3, "", "z"),
            (None, "g h i j k", "n"), (4, "g h i j k", "o"), (5, "only once here", "p"), (None, None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text_hash string")
    want = sorted([(1, "a b c d e f", "x"), (3, "", "z"), (3, "", "z"), (None, "g h i j k", "n"), (5, "only once here", "p"),
                   (None, None, "q")], key=str)
    for limit in (jaccard.BROADCAST_ROWS, 0):
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", limit)
        assert sorted(map(tuple, jaccard.one_of_each(df).collect()), key=str) == want
    assert jaccard.one_of_each(df.limit(0)).collect() == []
