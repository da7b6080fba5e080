"""Networks fitted on every labelled text, in rounds of parallel parts.

The rows are dealt to parts by the hash of their id. In a round every part starts from the common
weights and learns from all of its rows, in batches; then the changes are averaged, each weight's over
the parts that changed it. Parts stream their rows, blocks of bounded bytes at a time, so a round's
memory does not grow with the table; the averages are made by Spark, and the driver holds one set of
weights. Neither the number of tasks nor their order changes the result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.blocks import blocks, filled, flat, release
from riskloom.llm.sampling import Adam

#: Rows of a part; beyond ``MOST_PARTS`` parts they grow with the table.
PART_ROWS, MOST_PARTS = 4_000, 256
ROUNDS = 8
#: A part with fewer batches passes over its rows more than once in a round.
ROUND_STEPS = 120
#: Weights averaged in one group.
PIECE = 16_384
BLOCK_BYTES = 2 << 20
#: Bits by which texts without a label are left out before the shuffle: bits per label, least and most.
ROOM, LEAST_BITS, MOST_BITS = 32, 1 << 22, 1 << 26
_CHANGES = "part int, name string, piece int, data binary"
_PREPARED = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("y", T.IntegerType()),
    T.StructField("apart", T.BooleanType()), T.StructField("kind", T.IntegerType()),
    T.StructField("data", T.BinaryType())])


def _likely(docs, known, ids):
    """The rows of ``docs`` whose id is one of the ``ids`` different ones of ``known``, and few others.

    Bits of the ids' hashes stand in bitmaps of 4 KB, ``MOST_BITS`` in all at most, which are broadcast.
    A row passes by chance with a probability of ids per bit; beyond that many ids all rows may pass.
    """
    size = min(max(LEAST_BITS, 1 << (ROOM * ids).bit_length()), MOST_BITS)
    place = F.pmod(F.xxhash64(F.lit("likely"), "doc_id"), F.lit(size))
    bits = known.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
    maps = bits.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    found = docs.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)}).join(
        F.broadcast(maps), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_bit div 8 + 1 as int), 1)")), 16, 10).cast("int")
    return found.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).where("doc_id is not null").select(*docs.columns)


class Rows:
    """The texts of all label rows that the condition ``rows`` allows, prepared once and kept on the
    executors in parts.

    An id labelled twice counts once, with the larger label; null ids and labels are left out. Of the
    texts of a repeated id the least is taken, a null text is the empty one.
    ``prepare`` makes of an Arrow column of texts (a binary value, a number) per text; every
    ``apart``-th row is kept from the fit (0: none). As a context manager it lets the rows go.

    Texts and labels meet in their part, in one shuffle that carries the labelled texts once and few
    others: a bitmap of the labelled ids' hashes, of bounded size, tells most others where they are read.
    """

    def __init__(self, docs, labels, label, rows, prepare, apart=0, part_rows=PART_ROWS):
        id_ = F.col("doc_id")
        known = labels.filter(rows & id_.isNotNull() & F.col(label).isin(0, 1)).select(
            "doc_id", F.lit(None).cast("string").alias("text"), F.col(label).cast("int").alias("y"))
        labelled = known.select("doc_id").distinct().count()
        self.parts = min(max(1, labelled // part_rows), MOST_PARTS)
        kept = F.pmod(F.xxhash64(F.lit("apart"), id_), F.lit(apart)) == 0 if apart else F.lit(False)
        written = _likely(docs.select("doc_id", "text"), known, labelled).withColumn("y", F.lit(None).cast("int"))
        dealt = written.unionAll(known).withColumn(
            "part", F.pmod(F.xxhash64(id_), F.lit(self.parts)).cast("int")).repartition(self.parts, "part")
        # The groups lie within the parts: rows of documents have no label, rows of labels no text.
        texts = dealt.groupBy("part", "doc_id").agg(
            F.coalesce(F.min("text"), F.lit("")).alias("text"), F.max("y").alias("y"),
            F.bool_or(F.col("y").isNull()).alias("written")).where("written and y is not null")
        self.table = texts.sortWithinPartitions("part", F.xxhash64(F.lit("place"), id_), id_).select(
            "part", "y", kept.alias("apart"), "text").mapInArrow(_prepared(prepare), _PREPARED).persist(
            StorageLevel.MEMORY_AND_DISK)
        self.counts = {(r["apart"], r["y"]): r["n"] for r in self.table.groupBy("apart", "y").agg(
            F.count(F.lit(1)).alias("n")).collect()}

    def fitted(self, y=None):
        """Number of rows that are fitted (of the class)."""
        return sum(n for (apart, mine), n in self.counts.items() if not apart and y in (None, mine))

    def __len__(self):
        return sum(self.counts.values())

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.table.unpersist()

    def summed(self, count, size):
        """Sum over all fitted blocks of the integer vectors of ``count(data, edges)``."""
        def run(batches):
            total = np.zeros(size, np.int64)
            for _, y, _, data, edges in _blocks(batches):
                total += count(data, edges)
            yield _changes(0, {"sum": total}, np.int64)

        pieces = _merged(self.table.where("not apart").mapInArrow(run, _CHANGES), np.int64, np.sum)
        return pieces.get("sum", np.zeros(size, np.int64))

    def fit(self, weights, gradients, batch, rate, seed, rounds=None):
        """The weights, {name: array}, after ``rounds`` (``ROUNDS``) rounds over all fitted rows.

        ``gradients(weights)`` returns a function from (data, edges) of a block to one from rows of
        the block and their labels to gradients by name. ``batch``: rows of a step.
        """
        rounds = rounds or ROUNDS
        shapes = {n: w.shape for n, w in weights.items()}
        expected = self.fitted() / self.parts
        repeats = max(1, round(ROUND_STEPS / max(1, expected / batch)))
        source = self.table.where("not apart")
        for number in range(rounds):
            learn = _round(weights, gradients, batch, rate, seed, number, rounds, repeats, expected)
            mean = _merged(source.mapInArrow(learn, _CHANGES), np.float32, _mean_of_changes)
            weights = {n: w + mean[n].reshape(shapes[n]) if n in mean else w for n, w in weights.items()}
        return weights


def _prepared(prepare):
    def run(batches):
        for batch in batches:
            for part in blocks(batch, batch.schema.get_field_index("text"), BLOCK_BYTES):
                data, kind = prepare(filled(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), part.column("y"), part.column("apart"),
                     pa.array(kind, pa.int32()), pa.array(data, pa.binary())], _PREPARED.fieldNames())
        release()

    return run


def _blocks(batches):
    """(part, labels, numbers, bytes, edges in them) of consecutive rows of a part."""
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            for block in _cut(batch.slice(a, b - a)):
                y, kind = (block.column(n).to_numpy(zero_copy_only=False) for n in ("y", "kind"))
                yield int(part[a]), y.astype(float), kind, *flat(block.column("data"))


def every_block(table, compute, ddl):
    """A row of ``ddl`` per row of the table: ``compute(labels, numbers, data, edges)`` returns the columns."""
    schema = T.StructType.fromDDL(ddl)
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        for _, *block in _blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(compute(*block), kinds)], schema.fieldNames())
        release()

    return table.mapInArrow(run, schema)


def _cut(batch):
    return blocks(batch, batch.schema.get_field_index("data"), BLOCK_BYTES)


def _round(weights, gradients, batch, rate, seed, number, rounds, repeats, expected):
    """Task function: the changes that a round makes to the weights, by part."""
    def run(batches):
        learner = None
        for block in _blocks(batches):
            if learner is None or learner.part != block[0]:
                if learner is not None:
                    yield learner.changes()
                learner = _Learner(block[0], weights, gradients, batch, rate, seed, number, rounds,
                                   repeats, expected)
            learner.take(*block[1:])
        if learner is not None:
            yield learner.changes()
        learner = None
        release()

    return run


class _Learner:
    """One part in one round. Its rows are held only if it passes over them again."""

    def __init__(self, part, weights, gradients, batch, rate, seed, number, rounds, repeats, expected):
        self.part, self.before = part, weights
        self.now = {n: w.copy() for n, w in weights.items()}
        self.gradients = gradients(self.now)
        self.batch, self.adam = batch, Adam(self.now, rate)
        self.draw = np.random.default_rng([seed, number, part])
        self.number, self.rounds, self.repeats = number, rounds, repeats
        self.steps, self.expected, self.held = 0, max(1.0, expected * repeats), []

    def take(self, y, kind, data, edges):
        if self.repeats > 1:
            self.held.append((y, data, edges))
        self._learn(y, data, edges)

    def _learn(self, y, data, edges):
        block = self.gradients(data, edges)
        order = self.draw.permutation(len(y))
        for a in range(0, len(order), self.batch):
            picked = order[a:a + self.batch]
            done = (self.number + min(1.0, self.steps / self.expected)) / self.rounds
            self.adam.step(block(picked, y[picked]), 1 - 0.9 * done)
            self.steps += len(picked)

    def changes(self):
        for _ in range(self.repeats - 1):
            for rows in self.held:
                self._learn(*rows)
        return _changes(self.part, {n: w - self.before[n] for n, w in self.now.items()}, np.float32)


def _changes(part, arrays, kind):
    """Rows of ``_CHANGES``: the arrays in pieces."""
    rows = []
    for name, values in arrays.items():
        values = np.asarray(values, kind).ravel()
        rows += [(part, name, a // PIECE, values[a:a + PIECE].tobytes()) for a in range(0, len(values), PIECE)]
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "name", "piece", "data"])


def _mean_of_changes(values, axis):
    touched = (values != 0).sum(axis=axis)
    return values.sum(axis=axis) / np.maximum(touched, 1)


def _merged(changes, kind, how):
    """{name: array} of the rows, every piece put together over the parts in their order."""
    def merge(rows):
        rows = rows.sort_values("part", kind="stable")
        values = np.stack([np.frombuffer(d, kind) for d in rows["data"]])
        first = rows.iloc[0]
        return pd.DataFrame({"part": [0], "name": [first["name"]], "piece": [first["piece"]],
                             "data": [how(values, axis=0).astype(kind).tobytes()]})

    pieces = changes.groupBy("name", "piece").applyInPandas(merge, _CHANGES).collect()
    out = {}
    for r in sorted(pieces, key=lambda r: (r["name"], r["piece"])):
        out.setdefault(r["name"], []).append(np.frombuffer(r["data"], kind))
    return {n: np.concatenate(p) for n, p in out.items()}
