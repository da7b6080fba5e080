"""Alignment of two tokenizations of the same bytes by interval coalescing.

All tokens of many texts lie on one line of bytes. They are sorted by start, the running maximum of
their ends is taken, and a group ends where a start reaches it: there tokens of both kinds end.
Tokens that overlap are expanded within a group; those of them that also end together are links.
The line has every stretch of text once, as neither tokenizer joins anything across its edges, and a
text is put together from its stretches; a task keeps bounded many of them for its next texts.

Link counts of the whole corpus meet the texts by blocks. A task numbers the different links of a
block of texts, and the texts keep these numbers, two bytes each mostly. Counts are added up over
the blocks' own lists and joined back to them, so a link that stands in every text costs one row per
block, and then stream through a sort by block in front of its texts.
"""

import copy
import functools
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.blocks import blocks, filled, ragged, running
from riskloom.llm.bpe import WORDS, Encoder, default_path
from riskloom.llm.scratch import kept_once

#: Bytes of text tokenized at a time, and of a block that shares its list of links.
PART_BYTES, BLOCK_BYTES = 1 << 19, 8 << 20
#: Longer texts are tokenized in parts, cut where neither tokenizer joins anything.
LONG_TEXT = 1 << 18
#: Stretches kept between runs of texts, and their characters; beyond this those met once are forgotten.
STORE_STRETCHES, STORE_CHARS = 150_000, 8 << 20
_SPACE = ord("▁")
_BETWEEN_WORDS = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")

_COUNTS = "n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups_sha256 string"
_SUMS = "n_best long, count_sum long"


def default_pieces():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- tokens of two vocabularies -------------------------------------------------------------------

class _Table:
    """Byte strings by id, for gathering many at once."""

    def __init__(self, words):
        self.data, self.edges = np.frombuffer(b"".join(words), np.uint8), running([len(w) for w in words])

    def lengths(self, ids):
        return self.edges[ids + 1] - self.edges[ids]

    def gather(self, ids):
        return self.data[ragged(self.edges[ids], self.lengths(ids))]


def _pieces_as_bytes(model):
    """What each piece stands for: its text with spaces, or the byte it names."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


@functools.lru_cache(maxsize=2)
def _pieces(path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    # Parts may be cut between words only if no piece has a space behind another character.
    words = [model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())]
    splits = not any("▁" in w for w in words)
    return model, _Table(_pieces_as_bytes(model)), splits, _Joins(model) if splits and _is_plain(model) else None


def _is_plain(model):
    """Whether every character of a text stands in the pieces as it is, or as its bytes."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    how, made = spec.normalizer_spec, spec.trainer_spec
    return (made.model_type == made.BPE and made.byte_fallback and not made.treat_whitespace_as_suffix
            and how.add_dummy_prefix and how.escape_whitespaces
            and not (how.precompiled_charsmap or how.remove_extra_whitespaces))


class _Joins:
    """Which neighbouring characters a piece has next to each other: only these are ever joined."""

    def __init__(self, model):
        plain = [model.id_to_piece(i) for i in range(model.get_piece_size())
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.pairs = np.array(sorted({ord(x) << 21 | ord(y) for p in plain for x, y in zip(p, p[1:])}), np.int64)
        within = set().union(*[p for p in plain if len(p) > 1])
        #: A character that joins nothing: behind it a stretch is encoded without a space before it.
        self.guard = min((p for p in plain if len(p) == 1 and p not in within), default=None)
        self.skip = len(model.encode(self.guard)) if self.guard else 0

    def __call__(self, left, right):
        key = left.astype(np.int64) << 21 | right
        return self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key


class Tokenizers:
    """Both tokenizers, made once per task; special strings are plain text for A."""

    def __init__(self, path_a, path_b):
        self.a = Encoder(path_a)
        self.a.vocabulary = copy.copy(self.a.vocabulary)
        self.a.vocabulary.special = {}
        v = self.a.vocabulary
        self.table_a = _Table([v.word_bytes[a:b].tobytes() for a, b in zip(v.word_edges[:-1], v.word_edges[1:])])
        self.b, self.table_b, self.splits, self.joins = _pieces(path_b)
        #: Whether texts may be cut into stretches; else each is encoded as a whole.
        self.cuts = self.joins is not None and self.joins.guard is not None and len(self.joins.pairs) > 0
        size = max(len(self.table_a.edges), len(self.table_b.edges))
        self.decimals = _Table([b"%d," % i for i in range(size)])

    def parts(self, text):
        """The text in parts whose tokens are together those of the text."""
        if len(text) <= LONG_TEXT or not self.splits:
            return [text]
        out, at = [], 0
        while (cut := _BETWEEN_WORDS.search(text, at + LONG_TEXT)) is not None:
            out.append(text[at:cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def encode(self, texts):
        """Ids and edges of A and B for non-empty texts, and which texts both give back exactly."""
        spaced = [" " + t for t in texts]
        a, cuts_a = self.a.encode(spaced)
        lists = self.b.encode(texts, num_threads=1)
        cuts_b = running([len(x) for x in lists])
        b = np.fromiter(itertools.chain.from_iterable(lists), np.int64, cuts_b[-1])
        raw = [t.encode() for t in spaced]
        return a, cuts_a, b, cuts_b, self._fine(b"".join(raw), running([len(r) for r in raw]), a, cuts_a, b, cuts_b)

    def encode_stretches(self, texts, words, edges):
        """The same for stretches of spaced texts; ``words`` are A's words in all, parted by ``edges``."""
        raw = [w.encode() for w in words]
        a, ends = self.a.vocabulary.encode_words(raw)
        cuts_a = ends[edges]
        guard, skip = self.joins.guard, self.joins.skip
        lists = self.b.encode([guard + t for t in texts], num_threads=1)
        sizes = np.array([len(x) for x in lists], np.int64)
        b = np.fromiter(itertools.chain.from_iterable(lists), np.int64, sizes.sum())
        b, cuts_b = b[ragged(running(sizes)[:-1] + skip, sizes - skip)], running(sizes - skip)
        places = running(list(map(len, raw)))[edges]
        return a, cuts_a, b, cuts_b, self._fine(b"".join(raw), places, a, cuts_a, b, cuts_b)

    def _fine(self, whole, edges, a, cuts_a, b, cuts_b):
        """Which stretches of the bytes ``whole``, parted by ``edges``, both tokenizers give back."""
        fine = np.ones(len(edges) - 1, bool)
        for table, ids, cuts in ((self.table_a, a, cuts_a), (self.table_b, b, cuts_b)):
            data, at = table.gather(ids).tobytes(), running(table.lengths(ids))[cuts]
            if data != whole or (at != edges).any():
                fine &= [data[x:y] == whole[v:w] for x, y, v, w in zip(at[:-1], at[1:], edges[:-1], edges[1:])]
        return fine


# --- intervals -----------------------------------------------------------------------------------

def coalesce(starts, ends):
    """Group number of each interval; groups are parted where a start reaches all ends before it."""
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    new = np.zeros(len(order), np.int64)
    new[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return group


def overlaps(starts_a, ends_a, starts_b, ends_b):
    """(place in A, place in B) of all pairs that share a byte; both sides are in order."""
    first = np.searchsorted(ends_b, starts_a, side="right")
    count = np.searchsorted(starts_b, ends_a, side="left") - first
    return np.repeat(np.arange(len(starts_a)), count), ragged(first, count)


class Aligned:
    """The alignment of a list of texts, as arrays over all of them; edges part the texts.

    ``encoded`` has the tokens of other strings than spaced texts."""

    def __init__(self, tokenizers, texts, encoded=None):
        a, cuts_a, b, cuts_b, fine = encoded or tokenizers.encode(texts)
        self.fine, t = fine, tokenizers
        held = [np.repeat(fine, np.diff(c)) for c in (cuts_a, cuts_b)]
        self.a, self.b = a[held[0]], b[held[1]]
        self.n_a, self.n_b = np.diff(cuts_a) * fine, np.diff(cuts_b) * fine
        at_a, at_b = running(t.table_a.lengths(self.a)), running(t.table_b.lengths(self.b))
        starts, ends = np.r_[at_a[:-1], at_b[:-1]], np.r_[at_a[1:], at_b[1:]]
        group = coalesce(starts, ends)
        self.group_a, self.group_b = group[:len(self.a)], group[len(self.a):]
        text_a = np.repeat(np.arange(len(texts)), self.n_a)
        pair_a, pair_b = overlaps(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:])
        self.n_overlaps = np.bincount(text_a[pair_a], minlength=len(texts))
        together = at_a[pair_a + 1] == at_b[pair_b + 1]
        self.link_a, self.link_b = self.a[pair_a[together]], self.b[pair_b[together]]
        self.n_links = np.bincount(text_a[pair_a[together]], minlength=len(texts))
        first = np.r_[True, self.group_a[1:] != self.group_a[:-1]] if len(self.a) else np.zeros(0, bool)
        self.n_groups = np.bincount(text_a[first], minlength=len(texts))
        self._decimals = t.decimals

    def groups_as_text(self):
        """For each text its groups ``a1,a2|b1;a3|b2,b3`` in bytes, every group with its ``;``."""
        ids = np.r_[self.a, self.b]
        side = np.repeat([0, 1], [len(self.a), len(self.b)])
        group = np.r_[self.group_a, self.group_b]
        order = np.lexsort((side, group))
        ids, side, group = ids[order], side[order], group[order]
        data = self._decimals.gather(ids).copy()
        ends = running(self._decimals.lengths(ids))
        last = np.ones(len(ids), bool)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        data[ends[1:][last] - 1] = np.where(side[last] == 0, ord("|"), ord(";"))
        cuts = ends[running(self.n_a + self.n_b)]
        whole = data.tobytes()
        return [whole[x:y] for x, y in zip(cuts[:-1], cuts[1:])]


# --- stretches of texts --------------------------------------------------------------------------

class Stretches:
    """Alignments of stretches of text, kept for the next texts that have them.

    A stretch is a word of A, or a run of words between which B may join something. So neither
    tokenizer joins anything across its edges, both have a token's end there, and the tokens, groups
    and links of a text are those of its stretches. Links are numbers of ``codes``, which keep them
    until ``rest``.
    """

    #: Rows of the figures behind five sums and whether a stretch is not fine.
    _HEAD, _TAIL, _CHARS, _USES = 6, 7, 8, 9

    def __init__(self, tokenizers):
        self.tokenizers = tokenizers
        self._clear()

    def _clear(self):
        self._drop()
        self.codes, self._sorted, self._number = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def rest(self):
        """Between blocks: no number of a link is held any more."""
        if len(self.codes) > STORE_STRETCHES:
            self._clear()

    def _numbers(self, codes):
        """The numbers of links, new ones behind the others."""
        new = np.setdiff1d(codes, self._sorted)
        at = np.searchsorted(self._sorted, new)
        self._number = np.insert(self._number, at, np.arange(len(self.codes), len(self.codes) + len(new)))
        self._sorted = np.insert(self._sorted, at, new)
        self.codes = np.concatenate([self.codes, new])
        return self._number[np.searchsorted(self._sorted, codes)]

    def distinct(self, links):
        """The different links, sorted, how often each is there, and the place of all in them."""
        times = np.bincount(links, minlength=len(self.codes))
        there = np.flatnonzero(times)
        there = there[np.argsort(self.codes[there])]
        rank = np.zeros(len(times), np.uint16 if len(there) <= 1 << 16 else np.uint32)
        rank[there] = np.arange(len(there))
        return self.codes[there], times[there], rank[links]

    def _drop(self):
        self.index, self.groups, self.figures = {}, [], np.zeros((10, 0), np.int32)
        self.links, self.edges = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _forget(self):
        """Keep what was met more than once since the last time, if that leaves room for others."""
        if len(self.index) <= STORE_STRETCHES and self.figures[self._CHARS].sum() <= STORE_CHARS:
            return
        keep = np.flatnonzero(self.figures[self._USES] > 1)
        if 2 * len(keep) > STORE_STRETCHES or 2 * self.figures[self._CHARS, keep].sum() > STORE_CHARS:
            return self._drop()
        keys, groups = list(self.index), self.groups
        self.index = {keys[i]: n for n, i in enumerate(keep.tolist())}
        self.groups = [groups[i] for i in keep.tolist()]
        starts, lengths = self.edges[keep], np.diff(self.edges)[keep]
        self.links, self.edges = self.links[ragged(starts, lengths)], running(lengths)
        self.figures = self.figures[:, keep]
        self.figures[self._USES] = 0

    def _places(self, keys):
        """Where each stretch is kept; new ones are aligned."""
        places = np.fromiter(map(self.index.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            lacking = [keys[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(lacking)))
            places[missing] = np.fromiter(map(self.index.__getitem__, lacking), np.int64, len(missing))
        return places

    def _learn(self, keys):
        texts, words, edges = keys, keys, np.arange(len(keys) + 1)
        if type(keys[0]) is tuple:  # new keys are all words or all runs of words
            texts, words = ["".join(k) for k in keys], list(itertools.chain.from_iterable(keys))
            edges = running([len(k) for k in keys])
        x = Aligned(self.tokenizers, texts, self.tokenizers.encode_stretches(texts, words, edges))
        ends = np.array([[ord(t[0]) for t in texts], [ord(t[-1]) for t in texts]], np.int32)
        ends[ends == ord(" ")] = _SPACE
        self.figures = np.concatenate([self.figures, np.array([
            x.n_a, x.n_b, x.n_groups, x.n_overlaps, x.n_links, ~x.fine, *ends, list(map(len, texts)),
            np.zeros(len(keys), np.int32)], np.int32)], axis=1)
        self.index.update(zip(keys, range(len(self.groups), len(self.groups) + len(keys))))
        self.groups += x.groups_as_text()
        self.links = np.concatenate([self.links, self._numbers(x.link_a << 32 | x.link_b)])
        self.edges = np.concatenate([self.edges, self.edges[-1] + running(x.n_links)[1:]])

    def of(self, texts):
        """Of non-empty texts: which are fine, five sums, groups in bytes, links and their edges."""
        if not self.tokenizers.cuts:
            x = Aligned(self.tokenizers, texts)
            sums = np.stack([x.n_a, x.n_b, x.n_groups, x.n_overlaps, x.n_links], axis=1)
            return x.fine, sums, x.groups_as_text(), self._numbers(x.link_a << 32 | x.link_b), running(x.n_links)
        self._forget()
        words = [WORDS.findall(" " + t) for t in texts]
        cuts = running([len(w) for w in words])
        words = list(itertools.chain.from_iterable(words))
        place = self._places(words)
        left, right = self.figures[self._TAIL, place[:-1]], self.figures[self._HEAD, place[1:]]
        near = np.flatnonzero((left == _SPACE) | (right != _SPACE))
        first = np.ones(len(words), bool)
        first[near + 1] = ~self.tokenizers.joins(left[near], right[near])
        first[cuts[:-1]] = True
        if not first.all():
            starts = np.flatnonzero(first)
            lengths = np.diff(np.r_[starts, len(words)])
            longer = np.flatnonzero(lengths > 1)
            runs = [tuple(words[a:a + n]) for a, n in zip(starts[longer].tolist(), lengths[longer].tolist())]
            place = place[starts]
            place[longer] = self._places(runs)
            cuts = running(first)[cuts]
        self.figures[self._USES] += np.bincount(place, minlength=len(self.groups)).astype(np.int32)
        *sums, bad = [np.diff(running(row[place])[cuts]) for row in self.figures[:self._HEAD]]
        lengths = np.diff(self.edges)[place]
        links = self.links[ragged(self.edges[place], lengths)]
        groups = list(map(self.groups.__getitem__, place.tolist()))
        return (bad == 0, np.stack(sums, axis=1), [b"".join(groups[a:b]) for a, b in zip(cuts[:-1], cuts[1:])],
                links, running(lengths)[cuts])


# --- blocks of texts -----------------------------------------------------------------------------

class _Text:
    """What is known of one text while its parts are read."""

    def __init__(self):
        self.sums, self.fine, self.digest, self.links = np.zeros(5, np.int64), True, hashlib.sha256(), []
        self.pending = b""

    def add(self, fine, sums, groups, links):
        self.fine &= bool(fine)
        self.sums += sums
        self.links.append(links)
        self.digest.update(self.pending + groups[:-1])
        self.pending = groups[-1:]

    def values(self):
        if not self.fine or not self.sums[0]:
            return [0, 0, 0, 0, 0, ""], []
        return [*self.sums.tolist(), self.digest.hexdigest()], self.links


def _texts(stretches, values):
    """A :class:`_Text` for each string; strings are tokenized in runs of ``PART_BYTES``."""
    out, run, size = [_Text() for _ in values], [], 0

    def flush():
        fine, sums, groups, links, at = stretches.of([p for _, p in run])
        for n, (owner, _) in enumerate(run):
            out[owner].add(fine[n], sums[n], groups[n], links[at[n]:at[n + 1]])
        run.clear()

    for n, value in enumerate(values):
        for part in stretches.tokenizers.parts(value) if value else ():
            run.append((n, part))
            size += len(part)
            if size >= PART_BYTES:
                flush()
                size = 0
    if run:
        flush()
    return out


def _in_blocks(df, path_a, path_b):
    """Rows of texts and, for each block of them, a row with its links; ``df`` has row and text."""
    counts = list(T.StructType.fromDDL(_COUNTS))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("row", df.schema["row"].dataType), *counts,
        T.StructField("links", T.BinaryType()), T.StructField("width", T.IntegerType()),
        T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def made(block, rows, texts, stretches):
        values, links = zip(*[t.values() for t in texts])
        sizes = [sum(map(len, x)) for x in links]
        codes, times, place = stretches.distinct(
            np.concatenate([np.zeros(0, np.int32), *itertools.chain.from_iterable(links)]))
        stretches.rest()
        cuts = running(sizes)
        n = len(texts)
        columns = [[block] * n, pa.concat_arrays(rows), *zip(*values),
                   [place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], [place.itemsize] * n, [None] * n, [None] * n]
        names = schema.fieldNames()
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(list(c), type=k) for c, k in zip(columns, kinds)], names=names)
        only = {"block": [block], "codes": [codes], "times": [times]}
        yield pa.RecordBatch.from_arrays(
            [pa.array(only.get(name, [None]), type=k) for name, k in zip(names, kinds)], names=names)

    def run(batches):
        from pyspark import TaskContext

        stretches, block = Stretches(Tokenizers(path_a, path_b)), TaskContext.get().partitionId() << 32
        rows, texts, size = [], [], 0
        for batch in batches:
            for part in blocks(batch, 1, PART_BYTES):
                values = filled(part.column(1)).to_pylist()
                rows.append(part.column(0))
                texts += _texts(stretches, values)
                size += sum(map(len, values))
                if size >= BLOCK_BYTES:
                    yield from made(block, rows, texts, stretches)
                    block, rows, texts, size = block + 1, [], [], 0
        if texts:
            yield from made(block, rows, texts, stretches)

    return df.select("row", "text").mapInArrow(run, schema)


def _with_sums(sorted_rows, row_type):
    """Task function: links' counts of a block come first, in the order of the texts' numbers."""
    schema = T.StructType([T.StructField("row", row_type), *T.StructType.fromDDL(_COUNTS), *T.StructType.fromDDL(_SUMS)])

    def run(batches):
        block, counts, best, ready = None, [], [], None
        for batch in batches:
            of, is_text = batch.column("block").to_numpy(), batch.column("is_text").to_numpy(zero_copy_only=False)
            code = np.stack([of, is_text], axis=1)
            cuts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]).any(axis=1)]) if len(of) else []
            for a, b in zip(cuts, [*cuts[1:], len(of)]):
                part = batch.slice(a, b - a)
                if of[a] != block:
                    block, counts, best, ready = of[a], [], [], None
                if not is_text[a]:
                    counts.append(part.column("count").to_numpy())
                    best.append(part.column("best").to_numpy())
                    continue
                if ready is None:
                    ready = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (best, counts)]
                links, widths = part.column("links").to_pylist(), part.column("width").to_numpy()
                place = np.frombuffer(b"".join(links), np.uint16 if widths[0] == 2 else np.uint32)
                edges = running([len(x) for x in links]) // widths[0]
                sums = [np.diff(running(values[place])[edges]) for values in ready]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in schema.fields[:-2]], *map(pa.array, sums)], names=schema.fieldNames())

    return sorted_rows.mapInArrow(run, schema)


def align(df, text="text", keep=None, path_a=None, path_b=None):
    """Alignment figures of each whole text of ``df`` under a byte-level BPE (A) and a piece model (B).

    A encodes a space and the text (special strings are plain text), B the text, whose space it adds.
    Returns the columns ``keep`` (all unless given) with ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_overlaps`` (pairs of tokens that share a byte), ``n_links`` (those that end together),
    ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``), ``n_best`` (links whose pair of ids is linked, in
    the whole table, as often as any pair with that B id) and ``count_sum`` (their counts added up).
    Kept columns with these names (in any case) give way.

    A null or empty text, or one that either tokenizer does not give back byte by byte, has no
    tokens: zeros and an empty ``groups_sha256``, and no part in the counts. Repeated rows count
    each; rows without an id are rows like any others. An empty table gives no rows. Long texts are
    tokenized in parts cut between two ASCII words, where no token of either kind can reach across;
    a long text without such a place is one part.
    """
    made = [f.name for f in T.StructType.fromDDL(f"{_COUNTS}, {_SUMS}")]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    source = df.select(F.struct(*[df[f"`{c}`"] for c in keep]).alias("row"), df[text].cast("string").alias("text"))
    table = kept_once(_in_blocks(source, path_a or default_path(), path_b or default_pieces()), "links")
    own = table.where("codes IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("block", "x.*")
    of_b = Window.partitionBy(F.col("codes").bitwiseAND(F.lit((1 << 32) - 1)))
    counts = own.groupBy("codes").agg(F.sum("times").alias("count")).withColumn(
        "best", (F.col("count") == F.max("count").over(of_b)).cast("long"))
    found = own.select("block", "codes").join(counts, "codes").withColumn("is_text", F.lit(False))
    texts = table.where("codes IS NULL").drop("codes", "times").withColumn("is_text", F.lit(True))
    both = found.unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("block").sortWithinPartitions("block", "is_text", "codes")
    done = _with_sums(ordered, table.schema["row"].dataType)
    return done.select(*[F.col("row")[c].alias(c) for c in keep], *made)
