"""Documents in shards of equal bytes by histogram sort; native expressions only.

Rows are ordered by the key (hash of the text, hash of the id, row number), so equal texts stand
together. A shard is a range of keys. Its splitters are found without sorting anything: every pass
counts the bytes between candidate keys (probes) inside the ranges that still hold a splitter, the
driver keeps the one range of each splitter, and the next probes divide that. Ranges shrink to the
keys found in them, so few passes do. When all splitters stand, rows are exchanged once.

A splitter lies between two texts if that is near enough to its target (``GROUP_TOLERANCE`` of a
shard), else between the two rows that come nearest, even inside a group of equal texts. Both are
places in the sorted order and do not depend on the probes.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Window, functions as F

from riskloom.llm.scratch import kept_once

LAW = "bytes"
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: How far, in shards, a splitter may be from its target so that equal texts stay together.
GROUP_TOLERANCE = 0.01
#: Counters of a pass over all ranges; at most so many rows come to the driver.
COUNTERS = 16_384
#: Rows and bytes that one task numbers.
PIECE_ROWS, PIECE_BYTES = 100_000, 256 << 20

_PARTS = ("h", "k", "u")
_LEAST = -1  # below every part of a key


def _hash60(text):
    """The first 60 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Range:
    """Keys whose first parts are ``prefix`` and whose next part is within [low, high]."""

    prefix: tuple
    low: int
    high: int
    before: int  # bytes of all smaller keys

    def holds(self):
        part = F.col(_PARTS[len(self.prefix)])
        inside = (part >= self.low) & (part <= self.high)
        for name, value in zip(_PARTS, self.prefix):
            inside &= F.col(name) == value
        return inside

    def probe(self, count):
        """Number of probes at or below a row's key."""
        step = (self.high - self.low) // count + 1
        return F.floor((F.col(_PARTS[len(self.prefix)]) - self.low) / F.lit(step)) if step > 1 << 52 else (
            F.expr(f"({_PARTS[len(self.prefix)]} - {self.low}L) div {step}L"))

    def bound(self, value):
        """The least key whose part here is ``value``."""
        return (*self.prefix, value, *[_LEAST] * (len(_PARTS) - len(self.prefix) - 1))


def _counted(table, ranges):
    """Per range the ascending counters (bytes, rows, least part, greatest part)."""
    probes = max(2, COUNTERS // len(ranges))
    at = probe = None
    for n, r in enumerate(ranges):
        at = F.when(r.holds(), n) if at is None else at.when(r.holds(), n)
        probe = F.when(r.holds(), r.probe(probes)) if probe is None else probe.when(r.holds(), r.probe(probes))
    part = None
    for n, r in enumerate(ranges):
        own = F.col(_PARTS[len(r.prefix)])
        part = F.when(r.holds(), own) if part is None else part.when(r.holds(), own)
    rows = table.select(at.alias("at"), probe.alias("probe"), part.alias("part"), "size").where("at IS NOT NULL")
    found = rows.groupBy("at", "probe").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
    out = [[] for _ in ranges]
    for r in sorted(found.collect(), key=lambda r: (r["at"], r["probe"])):  # at most COUNTERS rows
        out[r["at"]].append((r["bytes"], r["n"], r["low"], r["high"]))
    return out


def _nearer(target, before, after):
    """True if ``before`` is at least as near."""
    return target - before <= after - target


def splitters(table, shards, total, tolerance=GROUP_TOLERANCE):
    """The ``shards - 1`` least keys of the shards after the first, for a table of h, k, u, size.

    Counts are kept times ``shards`` so that targets are whole numbers.
    """
    if not total:
        return []
    allowed = tolerance * total
    found, whole = {}, Range((), 0, (1 << 60) - 1, 0)
    open_ = {n: whole for n in range(1, shards)}
    while open_:
        ranges = list(dict.fromkeys(open_.values()))
        counters, going = dict(zip(ranges, _counted(table, ranges))), {}
        for n, where in open_.items():
            target, below = total * n, where.before
            for size, rows, low, high in counters[where]:
                if shards * (below + size) > target:
                    break
                below += size
            before, after = shards * below, shards * (below + size)
            low_side = _nearer(target, before, after)
            error = min(target - before, after - target)
            last = len(where.prefix) == len(_PARTS) - 1
            if low < high:
                going[n] = Range(where.prefix, low, high, below)
            elif rows == 1 or last or error == 0 or not where.prefix and error <= allowed:
                found[n] = where.bound(low if low_side else low + 1)
            else:
                going[n] = Range((*where.prefix, low), 0, (1 << 63) - 2, below)
        open_ = going
    return [found[n] for n in sorted(found)]


def _at_least(bound):
    """Is a row's key at or above ``bound``?"""
    h, k, u = (F.col(name) for name in _PARTS)
    return (h > bound[0]) | ((h == bound[0]) & ((k > bound[1]) | ((k == bound[1]) & (u >= bound[2]))))


def _shard(bounds, low=0, high=None):
    """Number of bounds at or below a row's key, by halving."""
    high = len(bounds) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(_at_least(bounds[middle]), _shard(bounds, middle + 1, high)).otherwise(
        _shard(bounds, low, middle))


def place(df, shards, id="doc_id", text="text", keep=None, tolerance=GROUP_TOLERANCE):
    """The columns ``keep`` of ``df`` (all of them unless given) with their place in ``shards`` shards.

    Adds ``size`` (bytes of the text in UTF-8, none for null, and ``ROW_BYTES``), ``text_crc32``,
    ``shard`` and ``slot``, gapless from 0 within a shard; kept columns with these names (in any case)
    give way. Shards hold equal bytes but for the document at a border, which goes to the nearer
    side; one document of more bytes than a shard leaves its neighbours smaller or empty. Null and
    empty texts are one group of equal texts. A null id is an id like any other. Repeated rows take
    a place each; which of two rows equal in id and text comes first is the order of the input. An
    empty table gives no rows. Each task of ``repartition`` numbers a piece of a shard, so a shard's
    rows are in key order within pieces of ``PIECE_ROWS`` rows.
    """
    made = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    whole = F.coalesce(df[text].cast("string"), F.lit(""))
    table = kept_once(df.select(
        F.struct(*[df[f"`{c}`"] for c in keep]).alias("row"),
        (F.octet_length(whole) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), _hash60(whole).alias("h"),
        _hash60(F.coalesce(df[id].cast("string"), F.lit(""))).alias("k"),
        F.monotonically_increasing_id().alias("u")), "keys")
    rows, total = table.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    pieces = max(1, math.ceil(rows / shards / PIECE_ROWS), math.ceil(total / shards / PIECE_BYTES))
    placed = table.withColumn("shard", _shard(splitters(table, shards, total, tolerance))).withColumn(
        "piece", F.pmod("u", F.lit(pieces)))
    cell = ["shard", "piece"]
    counts = placed.groupBy(*cell).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy(*cell).orderBy(*_PARTS))
    return placed.join(offsets, cell).select(
        *[F.col("row")[c].alias(c) for c in keep], "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"), (F.col("offset") + within - 1).cast("long").alias("slot"))


def write(df, path, shards, **how):
    """Write ``df`` as one folder per shard under ``path``, each in the order of its slots."""
    place(df, shards, **how).write.partitionBy("shard").parquet(path)
