"""Cross-tokenizer alignment against the tokenizers' own libraries and plain loops."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskloom.llm import alignment, bpe

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = {c: b for c, b in bpe._letters().items()}


def tokens(text):
    """[(id, bytes)] of both, or two empty lists."""
    if not text:
        return [], []
    a = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in a.ids]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode())
         for i in B.encode(text) for p in [B.id_to_piece(i)]]
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    return a, b


def ends(side):
    return np.cumsum([len(x) for _, x in side]).tolist()


def one(text):
    a, b = tokens(text)
    at_a, at_b = ends(a), ends(b)
    groups, links, i, j = [], [], 0, 0
    for stop in sorted(set(at_a) & set(at_b)):
        ga, gb = [], []
        while i < len(a) and at_a[i] <= stop:
            ga.append(a[i][0]); i += 1
        while j < len(b) and at_b[j] <= stop:
            gb.append(b[j][0]); j += 1
        groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        links.append((ga[-1], gb[-1]))
    shared = sum(max(x - len(p[1]), y - len(q[1])) < min(x, y) for x, p in zip(at_a, a) for y, q in zip(at_b, b)) if len(a) < 300 else None
    return len(a), len(b), groups, shared, links


def brute(rows):
    per = [(i, one(t)) for i, t in rows]
    count = collections.Counter(x for _, p in per for x in p[4])
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted([(i, na, nb, len(g), len(ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "",
                    sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls))
                   for i, (na, nb, g, _, ls) in per], key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def found(df, **how):
    return sorted((tuple(r) for r in alignment.align(df, **how).select(*COLUMNS).collect()), key=str)


def texts_of(seed, n):
    pick = random.Random(seed)
    pieces = ["the ", "quick", " brown", "  ", "\n", "\t", "ñandú", "😀", "▁", "<s>", "<|endoftext|>", "<0x41>", "1234", " 12",
              "don't", "ﬁ", "\x00", "　", "中文", "é", "<unk>", "ABC", "aaaa", ".", "..."]
    return [(i, "".join(pick.choice(pieces) for _ in range(pick.randrange(0, 30)))) for i in range(n)]


def test_equals_loops(spark):
    rows = [*texts_of(1, 150), (900, None), (901, ""), (901, ""), (None, "the quick"), (None, None), *texts_of(1, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df) == brute(rows)


def test_small_blocks_and_parts(spark, monkeypatch):
    """Blocks of few texts, texts in parts, wide link numbers make no difference."""
    rows = [*texts_of(2, 40), (77, " ".join(["some words of a longer text"] * 40)), (78, "x" * 3000), (79, "a ▁ b " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    small = alignment._in_blocks

    def in_small_blocks(*args):
        alignment.PART_BYTES, alignment.BLOCK_BYTES, alignment.LONG_TEXT = 300, 900, 60
        return small(*args)

    for name in ("PART_BYTES", "BLOCK_BYTES", "LONG_TEXT"):
        monkeypatch.setattr(alignment, name, getattr(alignment, name))
    monkeypatch.setattr(alignment, "_in_blocks", in_small_blocks)
    assert found(df) == brute(rows)


def test_parts_keep_all_tokens(monkeypatch):
    monkeypatch.setattr(alignment, "LONG_TEXT", 20)
    t = alignment.Tokenizers(bpe.default_path(), alignment.default_pieces())
    text = "Some words, and 12 more words\n\n with gaps   and ñ letters in it, then a long tail of words"
    parts = t.parts(text)
    assert len(parts) > 2 and " ".join(parts) == text
    whole, cut = alignment.Aligned(t, [text]), alignment.Aligned(t, parts)
    assert whole.a.tolist() == cut.a.tolist() and whole.b.tolist() == cut.b.tolist()


def odd_texts(seed, n):
    """Texts whose words' edges are no edges of B's pieces: spaces, line ends, contractions, marks."""
    pick = random.Random(seed)
    pieces = ["a", "I", "'s", "'somed", "'ll", "don't", " ", "  ", "     ", "\n", "\r\n", "\t", "\n \t", ");", "->", ".\r", "12", "²",
              "².", "e\u0301", "\u0301", "\u200b", "▁", "▁▁", "<0x0A>", "</s>", "\x01", "\x01a", "😀", "日本", "א", "\u00a0", "\u2003", "_x"]
    return ["".join(pick.choice(pieces) for _ in range(pick.randrange(1, 25))) for _ in range(n)]


def by_stretches(stretches, texts):
    """What is known of each text, links as pairs of ids."""
    out = []
    for text in alignment._texts(stretches, texts):
        values, links = text.values()
        codes = stretches.codes[np.concatenate([np.zeros(0, np.int32), *links])]
        out.append((*values, list(zip((codes >> 32).tolist(), (codes & 0xFFFFFFFF).tolist()))))
    return out


def whole(text):
    a, b, groups, shared, links = one(text)
    return a, b, len(groups), shared, len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", links


@pytest.mark.parametrize("room", [150_000, 60, 0])
def test_stretches_make_whole_texts(room, monkeypatch):
    """Texts put together from stretches are the texts tokenized as a whole, whatever is forgotten."""
    monkeypatch.setattr(alignment, "STORE_STRETCHES", room)
    monkeypatch.setattr(alignment, "PART_BYTES", 500)
    stretches = alignment.Stretches(alignment.Tokenizers(bpe.default_path(), alignment.default_pieces()))
    assert stretches.tokenizers.cuts
    texts = [*odd_texts(7, 400), *[x for _, x in texts_of(8, 150) if x], "the quick " * 30]
    assert by_stretches(stretches, texts) == [whole(x) for x in texts]


def test_whole_texts_where_nothing_may_be_cut():
    """As with a piece model that changes characters: texts are tokenized whole."""
    t = alignment.Tokenizers(bpe.default_path(), alignment.default_pieces())
    t.cuts = False
    texts = odd_texts(9, 60)
    assert by_stretches(alignment.Stretches(t), texts) == [whole(x) for x in texts]


def test_a_stretch_is_encoded_once(monkeypatch):
    """Words that texts share are encoded for the first of them only, and no store grows without end."""
    t = alignment.Tokenizers(bpe.default_path(), alignment.default_pieces())
    stretches, seen, encode = alignment.Stretches(t), [], t.encode_stretches
    monkeypatch.setattr(t, "encode_stretches", lambda texts, *how: seen.extend(texts) or encode(texts, *how))
    monkeypatch.setattr(alignment, "STORE_STRETCHES", 100)
    monkeypatch.setattr(alignment, "PART_BYTES", 40)
    alignment._texts(stretches, ["some words that stand in every text"] * 50)
    assert len(seen) == 7
    for i in range(300):
        alignment._texts(stretches, [f"some words w{'xyz'[i % 3] * (i + 2)}"])
        assert len(stretches.index) <= 105
    assert seen.count(" some") == 1


def test_overlaps_and_groups():
    t = alignment.Tokenizers(bpe.default_path(), alignment.default_pieces())
    texts = [x for _, x in texts_of(3, 200) if x]
    got = alignment.Aligned(t, texts)
    assert got.n_overlaps.tolist() == [one(x)[3] or 0 for x in texts]
    assert [g.decode().rstrip(";") for g in got.groups_as_text()] == [";".join(one(x)[2]) for x in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_coalesce_any_intervals(seed):
    """Groups are the connected runs of intervals that share inner points."""
    rng = np.random.default_rng(seed)
    starts = rng.integers(0, 60, 40)
    stops = starts + rng.integers(1, 6, 40)
    covered = {p for s, e in zip(starts, stops) for p in range(s, e - 1)}  # no cut behind these
    cuts = [p + 1 for p in range(70) if p not in covered]
    want = np.searchsorted(cuts, starts, side="right")
    got = alignment.coalesce(starts, stops)
    assert len(set(zip(want.tolist(), got.tolist()))) == len(set(got.tolist())) == len(set(want.tolist()))


def test_hostile_and_empty(spark, hostile, empty):
    rows = [(r["doc_id"], r["text"]) for r in hostile.collect()]
    assert found(hostile) == brute(rows)
    assert alignment.align(hostile).columns[:len(hostile.columns)] == hostile.columns
    assert alignment.align(empty).collect() == []
    clash = hostile.withColumnRenamed("shard", "N_A").withColumnRenamed("score", "block").withColumnRenamed("key", "is_text")
    assert found(clash) == brute(rows)


def test_query(spark, sf):
    from riskloom.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_token_alignment(spark, sf).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
