"""Context-triggered piecewise hashing: fingerprints that stay alike when a text is edited in parts.

A rolling hash over seven bytes marks the ends of chunks; what lies between is hashed to one
symbol. Block sizes are powers of two and nested: the end of a chunk at one size is an end at all
smaller ones. A text takes the smallest size with at most 64 chunks and is written down at that
size and at the double. Fingerprints are compared where they have a size in common.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T, Window

from riskloom.llm.blocks import BLOCK_BYTES, flat, running, with_text_columns

ROLLING, LONGEST = 7, 64
SMALLEST, LARGEST = 1, 40
ROWS_PER_BUCKET = 1_000
BROADCAST_BUCKETS = 250_000
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base, count):
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x):
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _ends(data, edges, prefix, inverse):
    """(places behind which a chunk can end, their levels): level i at sizes up to 2 ** i."""
    at = np.arange(len(data))
    first = np.repeat(edges[:-1], np.diff(edges))
    window = (prefix[1:] - prefix[np.maximum(at - ROLLING + 1, first)]) * inverse[:len(data)]
    rolled = _mixed(window)
    places = np.flatnonzero((rolled & np.uint64((1 << SMALLEST) - 1)) == 0)
    value = rolled[places]
    # The lowest set bit is 2 ** level; a window that hashes to 0 ends chunks of every size.
    low = value & (~value + np.uint64(1))
    level = np.where(low == 0, LARGEST, np.minimum(
        np.log2(np.maximum(low, 1).astype(float)).astype(np.int64), LARGEST))
    return places, level


def fingerprint_block(data, edges):
    """(level of each text, symbols, counts): two rows of up to 64 symbols per text, at the text's
    level and the next. Symbols are 12-bit numbers, -1 beyond the counts."""
    n = len(edges) - 1
    levels = np.full(n, SMALLEST)
    symbols, counts = np.full((2, n, LONGEST), -1, np.int16), np.zeros((2, n), np.int64)
    if not len(data):
        return levels, symbols, counts
    powers, inverse = _powers(_BASE, len(data)), _powers(_BASE_INVERSE, len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=prefix[1:])
    places, level = _ends(data, edges, prefix, inverse)
    owner = np.searchsorted(edges, places, side="right") - 1
    # Ends at a text's last byte close the tail, which is a chunk anyway.
    inner = places + 1 < edges[owner + 1]
    places, level, owner = places[inner], level[inner], owner[inner]
    tallies = np.bincount(owner * (LARGEST + 1) + level, minlength=n * (LARGEST + 1))
    at_least = np.cumsum(tallies.reshape(n, -1)[:, ::-1], axis=1)[:, ::-1]
    levels = SMALLEST + (at_least[:, SMALLEST:] >= LONGEST).sum(1)
    filled = np.diff(edges) > 0
    for row in (0, 1):
        chosen = level >= levels[owner] + row
        # Chunk starts: each text's first byte and the byte behind every chosen end.
        starts = np.sort(np.concatenate([edges[:-1][filled], places[chosen] + 1]))
        stops = np.append(starts[1:], edges[-1])
        text = np.searchsorted(edges, starts, side="right") - 1
        hashed = _mixed((prefix[stops] - prefix[starts]) * inverse[starts])
        number = np.bincount(text, minlength=n)
        place = np.arange(len(starts)) - running(number)[text]
        symbols[row, text, place] = (hashed >> np.uint64(52)).astype(np.int16)
        counts[row] = number
    return levels, symbols, counts


def written(levels, symbols, counts):
    """Fingerprints as strings: level, symbols at that level, symbols at the next."""
    high, low = _DIGITS[(symbols >> 6) & 63], _DIGITS[symbols & 63]
    letters = np.stack([high, low], axis=-1).reshape(2, -1, 2 * LONGEST)
    rows = [[bytes(r[:2 * c]).decode() for r, c in zip(letters[k], counts[k])] for k in (0, 1)]
    return [f"{level}:{a}:{b}" for level, a, b in zip(levels, *rows)]


def common(a, b):
    """Length of the longest common subsequence of rows of at most 64 symbols (-1 is padding):
    one machine word per row, one step per symbol."""
    n = len(a)
    out = np.zeros(n, np.int64)
    for first in range(0, n, 512):
        x, y = a[first:first + 512], b[first:first + 512]
        same = (x[:, None, :] == y[:, :, None]) & (y >= 0)[:, :, None]
        masks = np.packbits(same, axis=2, bitorder="little").view(np.uint64)[:, :, 0]
        row = np.full(len(x), np.iinfo(np.uint64).max, np.uint64)
        for k in range(LONGEST):
            hit = row & masks[:, k]
            row = (row + hit) | (row - hit)
        out[first:first + 512] = np.bitwise_count(~row)
    return out


def likeness(one, other):
    """1 - edit distance (insertions and deletions) / symbols of both, at the larger size that both
    have; 0 where sizes are incompatible, 1 for two empty texts."""
    (level_a, sym_a, n_a), (level_b, sym_b, n_b) = one, other
    step = level_b - level_a
    row_a, row_b = np.where(step > 0, 1, 0), np.where(step < 0, 1, 0)
    at = np.arange(len(level_a))
    a, b = sym_a[row_a, at], sym_b[row_b, at]
    total = n_a[row_a, at] + n_b[row_b, at]
    fits = np.abs(step) <= 1
    shared = np.zeros(len(at), np.int64)
    shared[fits] = common(a[fits], b[fits])
    empty = (n_a[0] == 0) & (n_b[0] == 0)
    alike = np.where(fits, 2 * shared / np.maximum(total, 1), 0.0)
    return np.where(empty, 1.0, np.where((n_a[0] == 0) | (n_b[0] == 0), 0.0, alike))


def parsed(fingerprints):
    """Arrays as ``fingerprint_block`` makes them, from strings."""
    values = np.zeros(256, np.int16)
    values[_DIGITS] = np.arange(64)
    levels = np.zeros(len(fingerprints), np.int64)
    symbols = np.full((2, len(fingerprints), LONGEST), -1, np.int16)
    counts = np.zeros((2, len(fingerprints)), np.int64)
    for i, fingerprint in enumerate(fingerprints):
        level, *rows = fingerprint.split(":")
        levels[i] = int(level)
        for k, row in enumerate(rows):
            codes = values[np.frombuffer(row.encode(), np.uint8)].reshape(-1, 2)
            counts[k, i] = len(codes)
            symbols[k, i, :len(codes)] = codes[:, 0] << 6 | codes[:, 1]
    return levels, symbols, counts


def fingerprints(df, text="text", column="fingerprint"):
    """``df`` with the fingerprint of each whole text; a null text has that of the empty text,
    equal texts have equal ones. A column with that name is replaced."""
    def block(texts):
        return [written(*fingerprint_block(*flat(texts)))]

    return with_text_columns(df, f"`{column}` string", lambda: block, text)


def similarity(one, other):
    """Likeness of two fingerprint columns, 0 to 1; null if either is null."""
    @F.arrow_udf(T.DoubleType())
    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        known = np.array([x.is_valid and y.is_valid for x, y in zip(a, b)], bool)
        both = [parsed([v.as_py() for v, k in zip(side, known) if k]) for side in (a, b)]
        out = np.zeros(len(a))
        if known.any():
            out[known] = likeness(*both)
        return pa.array(out, mask=~known)

    return compare(one, other)


def in_order(docs, rows_per_bucket=ROWS_PER_BUCKET):
    """Documents (doc_id, text) dealt into buckets of the order by descending id, each followed by
    a guest: the first document of the next bucket, behind the last bucket that of the first.

    Cut points are found on the ids in two steps (of the table, then within each part), so that
    neither the cuts in a row nor the rows in a bucket grow with the table. Null ids come last.
    The order among equal ids is that of the texts. Returns columns bucket, part, guest, doc_id,
    text, sorted within partitions that hold whole buckets.
    """
    ids = docs.select("doc_id")
    rows = ids.count()
    grid = max(1, int(np.ceil(np.sqrt(rows / rows_per_bucket))))
    points = "array(" + ",".join(f"{i / grid!r}D" for i in range(1, grid)) + ")"

    def cuts_of(frame):
        if grid == 1:
            return F.expr("cast(array() as array<bigint>)")
        return F.coalesce(F.expr(f"percentile_approx(doc_id, {points}, {20 * grid})"),
                          F.expr("cast(array() as array<bigint>)"))

    top = sorted(set(ids.agg(cuts_of(ids).alias("cuts")).first()["cuts"])) if grid > 1 else []
    top_cuts = F.expr("cast(array(%s) as array<bigint>)" % ",".join(map(str, top)))

    def place(cuts):
        # Null ids lie below all others.
        return F.when(F.col("doc_id").isNull(), -1).otherwise(
            F.size(F.filter(cuts, lambda c: c <= F.col("doc_id"))))

    # One row per part, about the square root of the number of buckets.
    inner = ids.withColumn("bucket", place(top_cuts)).groupBy("bucket").agg(
        cuts_of(ids).alias("cuts"))
    dealt = docs.withColumn("bucket", place(top_cuts)).join(F.broadcast(inner), "bucket", "left").withColumn(
        "part", place(F.col("cuts"))).drop("cuts")
    heads = ids.withColumn("bucket", place(top_cuts)).join(F.broadcast(inner), "bucket", "left").withColumn(
        "part", place(F.col("cuts"))).groupBy("bucket", "part").agg(F.max("doc_id").alias("head"))
    first = {r["bucket"]: r["head"] for r in heads.groupBy("bucket").agg(F.max("head").alias("head")).collect()}
    order = sorted(first, reverse=True)
    follow = F.lit(None).cast("long")
    for here, after in zip(order, order[1:] + order[:1]):
        follow = F.when(F.col("bucket") == here, F.lit(first[after]).cast("long")).otherwise(follow)
    row = Window.partitionBy("bucket").orderBy(F.col("part").desc())
    guests = heads.withColumn("last", F.lead("part").over(row).isNull()).select(
        F.struct("bucket", "part", F.lit(1).alias("guest")).alias("host"),
        F.when(F.col("last"), follow).otherwise(F.lead("head").over(row)).alias("doc_id"))
    guests = guests.groupBy("doc_id").agg(F.collect_list("host").alias("hosts"))
    # One row per bucket: few enough to send to every task, or else joined by a shuffle.
    if grid * grid <= BROADCAST_BUCKETS:
        guests = F.broadcast(guests)
    own = F.array(F.struct("bucket", "part", F.lit(0).alias("guest")))
    marked = dealt.join(guests, dealt["doc_id"].eqNullSafe(guests["doc_id"]), "left").select(
        dealt["doc_id"], "text",
        F.explode(F.concat(own, F.coalesce(F.col("hosts"), F.expr(
            "cast(array() as array<struct<bucket:int,part:int,guest:int>>)")))).alias("to"))
    return marked.select("to.*", "doc_id", "text").repartition("bucket", "part").sortWithinPartitions(
        "bucket", "part", "guest", F.col("doc_id").desc_nulls_last(), "text")


EDIT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")


def _arrays(texts):
    return fingerprint_block(*flat(pa.array(texts, pa.large_string())))


def _take(prints, rows):
    return prints[0][rows], prints[1][:, rows], prints[2][:, rows]


def compare_with_edits(docs, rows_per_bucket=ROWS_PER_BUCKET):
    """Per document of (doc_id, text): its fingerprint, that of an edited text, and likenesses.

    The edited text has its last third replaced by as many first characters of the next document in
    descending order of ids (all of it, if it is shorter), the last document's next being the
    first; a single document is its own next. A null text counts as empty. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def rows_of(batches):
        for batch in batches:
            names = ("bucket", "part", "guest", "doc_id", "text")
            yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names])

    def runs(batches):
        """Rows of one bucket in runs of bounded bytes; each run's last row opens the next run."""
        run, size = [], 0
        for row in rows_of(batches):
            if run and run[-1][:2] != row[:2]:
                yield run
                run, size = [], 0
            run.append(row)
            size += len(row[4])
            if size > BLOCK_BYTES and len(run) > 1:
                yield run
                run, size = run[-1:], len(run[-1][4])
        if run:
            yield run

    names = T.StructType.fromDDL(EDIT_DDL).fieldNames()

    def compute(batches):
        for run in runs(batches):
            # Of several guests (equal ids) the first follows.
            count = sum(1 for r in run if not r[2])
            run = run[:count + 1]
            mine = min(count, len(run) - 1)
            if not mine:
                continue
            texts = [r[4] for r in run]
            edited = []
            for text, after in zip(texts[:mine], texts[1:]):
                k = len(text) // 3
                edited.append(text[:len(text) - k] + after[:k])
            prints, changed = _arrays(texts), _arrays(edited)
            rows = np.arange(mine)
            own = _take(prints, rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[3] for r in run[:mine]], pa.int64()),
                pa.array([len(t) for t in texts[:mine]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(written(*own)), pa.array(written(*changed)),
                pa.array(likeness(own, changed)), pa.array(likeness(own, _take(prints, rows + 1))),
            ], names=names)

    return in_order(docs, rows_per_bucket).mapInArrow(compute, EDIT_DDL)
