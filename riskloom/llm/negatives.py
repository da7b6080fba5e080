"""Hard negatives of anchors by a secondary-sort shuffle.

A scored pair is one packed key: (anchor, descending score, positive before negative, id), so that
bytes sort as the pairs should. Keys are dealt by anchor and sorted within partitions; an iterator
then reads them once: a positive opens a window of scores, the negatives behind it are given out to
the windows they fall into, and a window closes when it is full or passed. Nothing of an anchor is
held but its open windows.

Pairs are scored in cells of some anchors and some rows. A cell holds its anchors, streams its rows
and keeps only pairs that can still be among the results: per anchor its best positives, and, once
the positives of all cells are known, per window the best negatives. So the shuffle carries a bounded
number of keys per anchor and cell instead of all pairs, and the result is the same.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F, types as T

from riskloom.llm.scratch import kept_once

#: Anchors of a cell, and bytes of their vectors (as doubles) that a task may hold.
ANCHORS_PER_CELL = 16_384
ANCHOR_BYTES = 64 << 20
#: Rows that one cell streams at most; their number bounds a task's time, not its memory.
ROWS_PER_CELL = 1 << 18
#: Scores computed at a time.
PAIRS_AT_ONCE = 1 << 21

_LONG = np.iinfo(np.int64)
_KEY = 25
_KEYS = T.StructType([T.StructField("key", T.BinaryType())])
_POSITIVES = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("scores", T.ArrayType(T.LongType()))])
RESULT = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()),
    T.StructField("rank", T.IntegerType()), T.StructField("negative_id", T.LongType()),
    T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType())])


# --- packed keys --------------------------------------------------------------------------------

def _ascending(values):
    """Longs as 8 bytes each that sort like the numbers."""
    flipped = values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return flipped.astype(">u8").view(np.uint8).reshape(-1, 8)


def _numbers(data):
    big = np.ascontiguousarray(data).view(">u8").ravel().astype(np.uint64)
    return (big ^ np.uint64(1 << 63)).view(np.int64)


def pack(anchor, score, kind, ids):
    """An Arrow column of keys; ``kind`` is 0 for positives and 1 for negatives."""
    out = np.empty((len(anchor), _KEY), np.uint8)
    out[:, :8], out[:, 8:16] = _ascending(anchor), ~_ascending(score)
    out[:, 16], out[:, 17:] = kind, _ascending(ids)
    edges = np.arange(len(anchor) + 1, dtype=np.int32) * _KEY
    return pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer(edges), pa.py_buffer(out)])


def unpack(keys):
    """(anchor, score, kind, id) of an Arrow column of keys."""
    at = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset] if len(keys) else 0
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[at:at + len(keys) * _KEY].reshape(-1, _KEY)
    return _numbers(data[:, :8]), _numbers(~data[:, 8:16]), data[:, 16], _numbers(data[:, 17:])


def _by_anchor(keys):
    """The secondary sort: keys of an anchor in one partition, in the order of their bytes."""
    return keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")


# --- scores -------------------------------------------------------------------------------------

def _matrix(column):
    """Vectors of a list column as whole numbers floor(256 x), short ones filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max(initial=0))
    whole = np.floor(256.0 * flat)
    if (lengths == width).all():
        return whole.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def _common(a, b):
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def _scores(a, b):
    """Exact inner products of all rows of ``a`` with all of ``b``, held within the range of a long."""
    a, b = _common(a, b)
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(a.shape[1], 1)
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    return np.clip(exact[0] @ exact[1].T, _LONG.min, _LONG.max).astype(np.int64)


def _sorted_places(anchor, score, ids):
    """Order by anchor, descending score, id; the scores of two places differ by less than 2^64."""
    return np.lexsort((ids, ~score, anchor))


def _rank_in(groups):
    """Place of each element in its run of equal (sorted) values, from 0."""
    first = np.r_[True, groups[1:] != groups[:-1]] if len(groups) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.r_[starts, len(groups)]))


class _Cell:
    """Anchors of one cell and the pairs kept so far: (anchor's place, score, id)."""

    def __init__(self, number, batches, width_of):
        self.number, self.per = number, width_of
        table = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: table.column(name).combine_chunks()
        self.ids = column("id").to_numpy()
        self.labels = column("label").unique()
        self.label = pc.index_in(column("label"), self.labels).to_numpy(zero_copy_only=False)
        self.vectors = _matrix(column("vector"))
        self.bound = np.full(len(self.ids), _LONG.min)
        if "scores" in table.column_names:
            self.windows = _padded(column("scores"), self.per[0])
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(3))

    def read(self, batch):
        """Look at all pairs of the anchors with the rows of ``batch``."""
        step = max(1, PAIRS_AT_ONCE // len(self.ids))
        label = pc.index_in(batch.column("label"), self.labels).fill_null(-1).to_numpy(zero_copy_only=False)
        ids, vectors = batch.column("id").to_numpy(), _matrix(batch.column("vector"))
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            score = _scores(self.vectors, vectors[part])
            same = self.label[:, None] == label[None, part]
            wanted = self.wanted(score, same, self.ids[:, None] == ids[None, part])
            place, row = np.nonzero(wanted)
            if len(place):
                self.merge(place, score[place, row], ids[part][row])

    def merge(self, place, score, ids):
        place, score, ids = (np.concatenate(p) for p in zip(self.kept, (place, score, ids)))
        order = _sorted_places(place, score, ids)
        place, score, ids = place[order], score[order], ids[order]
        stay = self.stay(place, score)
        self.kept = place[stay], score[stay], ids[stay]

    def keys(self):
        place, score, ids = self.kept
        return pack(self.ids[place], score, self.kind, ids)


class _Positives(_Cell):
    """The best rows of the anchor's own label."""

    kind = 0

    def wanted(self, score, same, itself):
        return same & ~itself & (score >= self.bound[:, None])

    def stay(self, place, score):
        rank = _rank_in(place)
        full = rank == self.per[0] - 1
        self.bound[place[full]] = score[full]
        return rank < self.per[0]


class _Negatives(_Cell):
    """Per window (score of a positive) the best rows of other labels."""

    kind = 1

    def wanted(self, score, same, itself):
        held = self.windows != _LONG.min
        low = np.where(held, self.windows, _LONG.max).min(axis=1)
        high = self.windows.max(axis=1)
        return ~same & (score <= high[:, None]) & _at_least(score, low[:, None], self.per)

    def stay(self, place, score):
        stay = np.zeros(len(place), bool)
        for w in range(self.windows.shape[1]):
            limit = self.windows[place, w]
            inside = np.flatnonzero((limit != _LONG.min) & (score <= limit) & _at_least(score, limit, self.per))
            stay[inside[_rank_in(place[inside]) < self.per[1]]] = True
        return stay


def _at_least(score, limit, per):
    """``per[2] * limit <= 100 * score`` without leaving the range of a long."""
    low = per[2]
    small = max(np.abs(score).max(initial=0), np.abs(limit[limit != _LONG.min]).max(initial=0)) < 1 << 55
    if small:
        return low * np.where(limit == _LONG.min, 0, limit) <= 100 * score
    return (low * limit.astype(object) <= 100 * score.astype(object)).astype(bool)


def _padded(column, width):
    """Lists of at most ``width`` longs as rows; the least long where a list has no more."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), width), _LONG.min)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _scored(cells, kind, per):
    """Task function over partitions of cells, anchors before rows."""

    def run(batches):
        cell, anchors, number = None, [], None
        for batch in batches:
            which, is_row = batch.column("cell").to_numpy(), batch.column("is_row").to_numpy(zero_copy_only=False)
            code = which * 2 + is_row
            cuts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else []
            for a, b in zip(cuts, [*cuts[1:], len(code)]):
                part = batch.slice(a, b - a)
                if which[a] != number:
                    if cell is not None:
                        yield pa.RecordBatch.from_arrays([cell.keys()], ["key"])
                    cell, anchors, number = None, [], which[a]
                if not is_row[a]:
                    anchors.append(part)
                elif anchors:
                    cell = cell or kind(number, anchors, per)
                    cell.read(part)
        if cell is not None:
            yield pa.RecordBatch.from_arrays([cell.keys()], ["key"])

    return cells.mapInArrow(run, _KEYS)


class _Grid:
    """Which cells rows and anchors go to: every pair meets in exactly one."""

    def __init__(self, spark, anchors, rows, width):
        tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        per_cell = max(1, min(ANCHORS_PER_CELL, ANCHOR_BYTES // (8 * max(width, 1))))
        self.groups = max(1, math.ceil(anchors / per_cell))
        self.blocks = max(math.ceil(tasks / self.groups), math.ceil(rows / ROWS_PER_CELL), 1)
        self.blocks = min(self.blocks, max(1, math.ceil(rows / 256)))

    def cells(self, anchors, rows):
        """One table in cells; rows go to a block by hash, which repeated rows may fill: they stream."""
        group = F.pmod(F.xxhash64("id"), F.lit(self.groups))
        block = F.pmod(F.xxhash64("id", "vector"), F.lit(self.blocks))
        more = [c for c in anchors.columns if c not in rows.columns]
        left = anchors.withColumn("is_row", F.lit(False)).withColumn("cell", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(self.blocks - 1)), lambda b: group * self.blocks + b)))
        right = rows.withColumns({c: F.lit(None).cast(anchors.schema[c].dataType) for c in more}).withColumn(
            "is_row", F.lit(True)).withColumn("cell", F.explode(F.transform(
                F.sequence(F.lit(0), F.lit(self.groups - 1)), lambda g: g * self.blocks + block)))
        return left.unionByName(right).repartition(
            self.groups * self.blocks, "cell").sortWithinPartitions("cell", "is_row")


# --- streams of sorted keys ---------------------------------------------------------------------

def _first_positives(per):
    """From sorted keys of positives: one row per anchor with its first ones."""

    def run(batches):
        anchor, ids, scores, out = None, [], [], []
        for batch in batches:
            for a, s, _, i in zip(*[v.tolist() for v in unpack(batch.column(0))]):
                if a != anchor:
                    if anchor is not None:
                        out.append((anchor, ids, scores))
                    anchor, ids, scores = a, [], []
                if len(ids) < per[0]:
                    ids.append(i)
                    scores.append(s)
            if len(out) > 1000:
                yield _batch(out, _POSITIVES)
                out = []
        if anchor is not None:
            out.append((anchor, ids, scores))
        if out:
            yield _batch(out, _POSITIVES)

    return run


def _windows(per):
    """From sorted keys: positives open windows, negatives are given out to the open ones."""

    def run(batches):
        anchor, open_, out = None, [], []
        for batch in batches:
            for a, score, kind, i in zip(*[v.tolist() for v in unpack(batch.column(0))]):
                if a != anchor:
                    anchor, open_ = a, []
                if kind == 0:
                    open_.append([i, score, 0])
                    continue
                open_ = [w for w in open_ if w[2] < per[1] and per[2] * w[1] <= 100 * score]
                for window in open_:
                    window[2] += 1
                    out.append((a, window[0], window[2], i, window[1], score))
            if len(out) > 10_000:
                yield _batch(out, RESULT)
                out = []
        if out:
            yield _batch(out, RESULT)

    return run


def _batch(rows, schema):
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=kinds.get(f.dataType, pa.list_(pa.int64()))) for c, f in zip(zip(*rows), schema)],
        names=schema.fieldNames())


def mine(df, is_anchor, id="vec_id", label="label", vector="embedding", positives=5, negatives=5, low=80):
    """Hard negatives of the rows of ``df`` for which the column ``is_anchor`` holds.

    Components count as floor(256 x); a score is the whole inner product. An anchor's positives are
    its ``positives`` best other rows of its label, and for each of them the ``negatives`` best rows
    of other labels are returned whose score is at most the positive's and at least ``low`` percent
    of it. Equal scores go by the smaller id. Labels of any type are compared as strings.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part.
    Of repeated anchor rows with one id the one with the least (label, vector) counts; other repeated
    rows count each. Rows with the anchor's own id are never its partners. Of vectors of different
    lengths the shorter is filled up with zeros. Other columns of ``df`` play no role, whatever their
    names. No rows, no anchors, no positives or no row in a window: no results.
    """
    per = (positives, negatives, low)
    kind = df.schema[vector].dataType.elementType
    vectors = df[vector] if kind in (T.FloatType(), T.DoubleType()) else df[vector].cast("array<double>")
    rows = df.select(df[id].cast("long").alias("id"), df[label].cast("string").alias("label"),
                     vectors.alias("vector"), is_anchor.alias("is_anchor"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull()
                      & F.col("vector").isNotNull() & ~bad)
    anchors = rows.where("is_anchor").groupBy("id").agg(
        F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    rows = rows.drop("is_anchor")
    size = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    grid = _Grid(df.sparkSession, anchors.count(), *size)
    found = kept_once(_by_anchor(_scored(grid.cells(anchors, rows), _Positives, per)).mapInArrow(
        _first_positives(per), _POSITIVES), "positives")
    with_windows = anchors.join(found.select(F.col("anchor").alias("id"), "scores"), "id")
    negative_keys = _scored(grid.cells(with_windows, rows), _Negatives, per)
    return _by_anchor(found.mapInArrow(_positive_keys, _KEYS).unionByName(negative_keys)).mapInArrow(
        _windows(per), RESULT)


def _positive_keys(batches):
    for batch in batches:
        counts = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pack(
            np.repeat(batch.column("anchor").to_numpy(), counts),
            batch.column("scores").flatten().to_numpy(), 0, batch.column("ids").flatten().to_numpy())], ["key"])
