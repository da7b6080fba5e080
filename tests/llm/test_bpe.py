import random

import numpy as np
import pytest

from riskloom.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def _split(ids, edges):
    return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]


def test_same_ids_and_texts_as_the_library(texts, library):
    draw = random.Random(3)
    values = [*texts.values(), "", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaaaaaaaaaaaa", "  \n\n\t x  ",
              "a\x1c\x1db \x85 c​ d", "it's we'LL they're", "".join(draw.choice("abcdefgh") for _ in range(20_000))]
    values += ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(0x3000), draw.randrange(0x1F300, 0x1F700)]))
                       for _ in range(120)) for _ in range(100)]
    wanted = [e.ids for e in library.encode_batch(values, add_special_tokens=False)]
    for store in (500_000, 50):
        encoder = bpe.Encoder(bpe.default_path(), store)
        found, decoded = [], []
        for first in range(0, len(values), 37):
            ids, edges = encoder.encode(values[first:first + 37])
            found += _split(ids, edges)
            decoded += encoder.vocabulary.decode(ids, edges)
        assert found == wanted and decoded == values
    assert [library.decode(w, skip_special_tokens=False) for w in wanted] == values


def test_every_character(library):
    values = ["".join(chr(c) + " " + chr(c) + "a1" for c in range(first, min(first + 64, 0x110000)) if not 0xD800 <= c < 0xE000)
              for first in range(0, 0x110000, 64)]
    encoder = bpe.Encoder(bpe.default_path())
    for first in range(0, len(values), 500):
        part = values[first:first + 500]
        assert _split(*encoder.encode(part)) == [
            e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_merge_rounds_against_one_word_at_a_time():
    tables, draw = bpe.vocabulary(bpe.default_path()), random.Random(5)
    rank = {int(k): int(r) for k, r in zip(tables.keys, tables.ranks)}
    words = [bytes(draw.choice(b"aabcdeinorst ") for _ in range(draw.randrange(1, 30))) for _ in range(300)]
    ids, edges = tables.encode_words(words)
    for word, found in zip(words, _split(ids, edges)):
        symbols = [int(tables.byte_ids[b]) for b in word]
        while True:
            ranks = [rank.get(a << 32 | b) for a, b in zip(symbols, symbols[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            at = ranks.index(best)
            symbols[at:at + 2] = [int(tables.made[best])]
        assert found == symbols


def test_columns(spark):
    df = spark.createDataFrame([(1, "héllo wörld"), (2, None)], "id int, text string")
    rows = bpe.decode(bpe.encode(df)).orderBy("id").collect()
    assert rows[0]["decoded"] == "héllo wörld" and rows[1]["ids"] == [] and rows[1]["decoded"] == ""
    digest = bpe.digests(df).orderBy("id").collect()
    assert [r["n_tokens"] for r in digest] == [len(r["ids"]) for r in rows]


def test_bytes_that_are_no_text():
    tables = bpe.vocabulary(bpe.default_path())
    ids = np.array([int(tables.byte_ids[0xC3])])
    assert tables.decode(ids, np.array([0, 1])) == ["�"]
