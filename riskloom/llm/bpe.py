"""Byte-level BPE: encoding and decoding with a vocabulary file, in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of every neighbouring
pair by binary search over the sorted pair keys, takes the lowest rank of each word and merges all
its places at once; words without a pair left leave the array. The vocabulary file is read where
the task runs; its path is a parameter.
"""

import functools
import hashlib
import json

import numpy as np
import regex

from riskloom.llm.blocks import ragged, running, with_text_columns

#: How the vocabulary's pre-tokenizer cuts a text (white space by Unicode property).
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

#: Words kept between blocks of a task; beyond this the store starts again.
STORE_WORDS = 150_000
#: Bytes of text at a time: a word object and its places take tens of times its bytes.
BLOCK = 1 << 19
_NONE = np.iinfo(np.int64).max


def default_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _letters():
    """The printable stand-in of each byte in the vocabulary file: itself if it is visible Latin-1,
    else the next free code point from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return {chr(b if b in set(visible) else next(rest)): b for b in range(256)}


class Vocabulary:
    """Pair keys with ranks and products, bytes of every id, and the special strings."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], _letters()
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {s.encode(): i for s, i in special.items()}
        size = max([*ids.values(), *special.values()]) + 1
        words = [b""] * size
        for word, i in ids.items():
            words[i] = bytes(letters[c] for c in word) if i not in special.values() else word.encode()
        for word, i in special.items():
            words[i] = word.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.word_edges = running([len(w) for w in words])
        decimals = [b"%d," % i for i in range(size)]
        self.decimal_bytes = np.frombuffer(b"".join(decimals), np.uint8)
        self.decimal_edges = running([len(w) for w in decimals])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def pair_ranks(self, left, right):
        """Merge ranks of pairs; ``_NONE`` where no merge joins them."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def encode_words(self, words):
        """(ids of all words one after the other, edges) for a list of words as bytes."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        finished = []
        rank = np.full(len(symbols), _NONE)
        if len(symbols) > 1:
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.pair_ranks(symbols[:-1], symbols[1:]), _NONE)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            stay = lowest != _NONE
            if not stay.all():
                held = np.repeat(stay, counts)
                finished.append((owner[~held], symbols[~held]))
                owner, symbols, rank = owner[held], symbols[held], rank[held]
                lowest, counts = lowest[stay], counts[stay]
                if not len(symbols):
                    break
            places = np.flatnonzero(rank == np.repeat(lowest, counts))
            # Overlapping places (one symbol three times and more): every second one of a run.
            new_run = np.r_[True, np.diff(places) != 1]
            first = places[new_run][np.cumsum(new_run) - 1]
            places = places[(places - first) % 2 == 0]
            symbols[places] = self.made[rank[places]]
            left = np.ones(len(symbols), bool)
            left[places + 1] = False
            symbols, owner, rank = symbols[left], owner[left], rank[left]
            places = places - np.arange(len(places))
            for at in (places, places[places > 0] - 1):
                inner = at[at + 1 < len(symbols)]
                rank[at[at + 1 >= len(symbols)]] = _NONE
                same = owner[inner] == owner[inner + 1]
                rank[inner] = np.where(same, self.pair_ranks(symbols[inner], symbols[inner + 1]), _NONE)
        if not finished:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        owners = np.concatenate([o for o, _ in finished])
        order = np.argsort(owners, kind="stable")
        return (np.concatenate([s for _, s in finished])[order],
                running(np.bincount(owners, minlength=len(words))))

    def decode(self, ids, edges):
        """Text of each range of ids; bytes that are no UTF-8 become replacement characters."""
        data, lengths = self._gather(self.word_bytes, self.word_edges, ids)
        cuts = running(lengths)[edges]
        whole = data.tobytes()
        return [whole[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]

    def decimals(self, ids, edges):
        """The ids of each range as decimal numbers joined by commas, in bytes."""
        data, lengths = self._gather(self.decimal_bytes, self.decimal_edges, ids)
        cuts = running(lengths)[edges]
        whole = data.tobytes()
        return [whole[a:max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:])]

    @staticmethod
    def _gather(table, table_edges, ids):
        starts, lengths = table_edges[ids], table_edges[ids + 1] - table_edges[ids]
        return table[ragged(starts, lengths)], lengths


@functools.lru_cache(maxsize=2)
def vocabulary(path):
    """The file's tables, kept by the Python worker for its next tasks."""
    return Vocabulary(path)


class Encoder:
    """Encodes blocks of texts; ids of words seen before are looked up."""

    def __init__(self, path, store_words=STORE_WORDS):
        self.vocabulary, self.limit = vocabulary(path), store_words
        self._clear()

    def _clear(self):
        self.index, self.ids, self.edges = {}, np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, words):
        """Give every word a place in the store; special strings come as tuples and get -1 - id."""
        new = set(words).difference(self.index)
        if not new:
            return
        if len(self.index) + len(new) > self.limit:
            self._clear()
            new = set(words)
        plain = [w for w in new if type(w) is str]
        for word in new.difference(plain):
            self.index[word] = -1 - self.vocabulary.special[word[0].encode()]
        ids, edges = self.vocabulary.encode_words([w.encode() for w in plain])
        first = len(self.edges) - 1
        self.index.update(zip(plain, range(first, first + len(plain))))
        self.ids = np.concatenate([self.ids, ids])
        self.edges = np.concatenate([self.edges, self.edges[-1] + edges[1:]])

    def encode(self, texts):
        """(ids of all texts one after the other, edges) for a list of strings."""
        words, counts, cut = [], [], self.vocabulary.cut
        special = [s.decode() for s in self.vocabulary.special]
        for text in texts:
            before = len(words)
            if any(s in text for s in special):
                for i, piece in enumerate(cut.split(text)):
                    words.extend([(piece,)] if i % 2 else WORDS.findall(piece))
            else:
                words.extend(WORDS.findall(text))
            counts.append(len(words) - before)
        self._learn(words)
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        marked = np.flatnonzero(places < 0)
        found = np.maximum(places, 0)
        if len(self.edges) > 1:
            starts, lengths = self.edges[found], self.edges[found + 1] - self.edges[found]
        else:
            starts, lengths = found, np.zeros(len(found), np.int64)
        if len(marked):  # one id each, written below: any place of the store does to hold it open
            starts[marked], lengths[marked] = 0, 1
        ends = running(lengths)
        at = ragged(starts, lengths)
        ids = self.ids[at] if len(self.ids) else np.zeros(len(at), np.int64)
        ids[ends[marked]] = -1 - places[marked]
        return ids, ends[running(counts)]


def encode(df, text="text", path=None, ids="ids", intact=None):
    """``df`` with the array of token ids of each whole text.

    ``intact`` names a column that tells whether the ids decode to the text. A null or empty text has no ids. A special string of the vocabulary inside a text is its
    special id, as the tokenizers library does by default. A column named like ``ids`` is replaced.
    """
    path = path or default_path()

    def start():
        encoder = Encoder(path)

        def block(texts):
            values = texts.to_pylist()
            flat_ids, edges = encoder.encode(values)
            made = [[flat_ids[a:b] for a, b in zip(edges[:-1], edges[1:])]]
            if intact:
                decoded = encoder.vocabulary.decode(flat_ids, edges)
                made.append([a == b for a, b in zip(decoded, values)])
            return made

        return block

    ddl = f"`{ids}` array<int>" + (f", `{intact}` boolean" if intact else "")
    return with_text_columns(df, ddl, start, text, size=BLOCK)


def decode(df, ids="ids", path=None, text="decoded"):
    """``df`` with the text of each array of ids, special ids included; null ids give an empty text."""
    import pandas as pd
    from pyspark.sql import functions as F

    path = path or default_path()

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        arrays = [np.zeros(0, np.int64) if a is None else np.asarray(a, np.int64) for a in column]
        edges = running([len(a) for a in arrays])
        joined = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
        return pd.Series(vocabulary(path).decode(joined, edges), dtype=object)

    return df.withColumn(text, texts(F.col(ids)))


def digests(df, text="text", path=None):
    """``df`` without its texts, with ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas)
    and ``decoded_sha256`` (the decoded text in UTF-8): encoded and decoded in one pass."""
    path = path or default_path()

    def start():
        encoder = Encoder(path)

        def block(texts):
            ids, edges = encoder.encode(texts.to_pylist())
            tables = encoder.vocabulary
            return [
                np.diff(edges),
                [hashlib.sha256(d).hexdigest() for d in tables.decimals(ids, edges)],
                [hashlib.sha256(d.encode()).hexdigest() for d in tables.decode(ids, edges)],
            ]

        return block

    return with_text_columns(
        df, "n_tokens long, ids_sha256 string, decoded_sha256 string", start, text, drop=[text], size=BLOCK)
