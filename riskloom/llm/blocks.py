"""Texts as blocks of bytes inside tasks, and columns computed from them.

``with_text_columns`` is how an operator in Python adds columns: Arrow batches are cut into blocks
of bounded size (a text longer than a block is a block of its own and is never cut), a function
made once per task turns a block into new columns.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.functions.memory import release

BLOCK_BYTES = 2 << 20


def filled(texts):
    """The Arrow column with empty texts for nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.fill_null("") if texts.null_count else texts


def flat(texts):
    """(bytes of all texts one after the other, first byte of each and the end): no copy is made."""
    texts = filled(texts)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, data = texts.buffers()
    edges = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[edges[0]:edges[-1]], edges - edges[0]


def running(values):
    """0 and the running sums, for sums over any range."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def code_points(data, edges):
    """Code points of each text: bytes that do not continue a character."""
    before = running((data & 0xC0) != 0x80)
    return before[edges[1:]] - before[edges[:-1]]


def ragged(starts, lengths):
    """Indexes start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def blocks(batch, column, size=BLOCK_BYTES):
    """The record batch in runs of rows whose texts have ``size`` bytes together, one row at least."""
    texts = filled(batch.column(column))
    _, edges = flat(texts)
    first, rows = 0, batch.num_rows
    while first < rows:
        last = int(np.searchsorted(edges, edges[first] + size, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield batch.slice(first, last - first)
        first = last


def unused(df, name):
    """``name``, or that with underscores behind it, as no column of ``df`` is called in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text_columns(df, ddl, start, text="text", drop=(), size=BLOCK_BYTES):
    """``df`` with the columns of ``ddl``, computed from the texts.

    ``start()`` runs once per task and returns a function from an Arrow column of texts (no nulls)
    to the new columns, as lists or arrays; it gets blocks of ``size`` bytes. Columns of ``df`` that have the name of a new column
    (in any case) give way to it, those in ``drop`` are left out.
    """
    added = T.StructType.fromDDL(ddl)
    gone = {f.name.lower() for f in added} | {d.lower() for d in drop}
    kept = [f for f in df.schema if f.name.lower() not in gone]
    source = df.select(*[f"`{f.name}`" for f in kept], df[text].alias(unused(df, "_the_text")))
    schema = T.StructType(kept + list(added))
    kinds = [to_arrow_type(f.dataType) for f in added]
    names = schema.fieldNames()

    def run(batches):
        compute = start()
        for batch in batches:
            for part in blocks(batch, len(kept), size):
                made = compute(filled(part.column(len(kept))))
                columns = [part.column(i) for i in range(len(kept))]
                columns += [pa.array(c, type=k) for c, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                made = columns = None
        compute = None
        release()

    return source.mapInArrow(run, schema)
