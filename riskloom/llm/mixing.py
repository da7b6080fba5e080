"""Mixing sources to target weights, over the whole corpus.

Targets are words per source. Every source is dealt by hash into blocks; whole copies and, for the
rest of a target, a random run of blocks make its exact block quota, which ends at the document
nearest to the target. A multivariate-hypergeometric splitting tree divides the quotas of all sources among the
output shards: at each node it draws how many blocks of each source go to the left half, so that
every shard gets its share of blocks and any split is as likely as when all blocks are shuffled.
A shard then takes the next blocks of each source's permutation, and shuffles its rows on its own.

Only one row per source and the counts of the tree are on the driver.
"""

from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F, Window

from riskloom.llm.scratch import kept_once, local_rows

BLOCKS = 1_024
#: Shards: a number, or None for one per so many words, within these bounds.
SHARDS, WORDS_PER_SHARD, MOST_SHARDS = 16, 5_000_000, 4_096
WORD = r"[^\x20\x09-\x0D]+"
#: More sources than this are refused: their table is held on the driver.
MAX_SOURCES = 100_000
#: Rows of the block plan up to which it goes to every task instead of shuffling the documents.
BROADCAST_BLOCKS = 200_000


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    """{source: words} for {source: size}: ``share`` of all sizes by weight, none above ``most``
    times its size; the excess is dealt again by weight until none is above.

    Sources are taken in code point order, null last, and weigh as ``weights``, repeating. Without
    words all targets are 0.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        each = left / sum(weight[s] for s in free)
        above = [s for s in free if each * weight[s] > most * sizes[s]]
        if not above:
            out.update({s: each * weight[s] for s in free})
            break
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def split_quotas(quotas, shards, seed):
    """Blocks of each source in each shard, an array (sources, shards) whose rows sum to the quotas
    and whose columns are equal to within one block per level of the tree."""
    out = np.zeros((len(quotas), shards), np.int64)
    nodes = [(0, shards, np.asarray(quotas, np.int64))]
    while nodes:
        low, high, mine = nodes.pop()
        if high - low == 1:
            out[:, low] = mine
            continue
        middle = (low + high) // 2
        take = int(mine.sum()) * (middle - low) // (high - low)
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(mine, take, method="marginals") if len(mine) else mine
        nodes += [(low, middle, left), (middle, high, mine - left)]
    return out


def _key(source):
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))


def sized(docs, seed=17):
    """``docs`` with _key (the source; null apart from all strings), _size, _hash and _block.

    The hash is of the id and the text: equal rows stay together, which changes nothing, as they
    are interchangeable.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "_key": _key(F.col("source").cast("string")),
        "_size": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "_hash": F.xxhash64(F.lit(seed), "doc_id", "text"),
    }).withColumn("_block", F.pmod(F.xxhash64(F.lit(seed + 1), "_hash"), F.lit(BLOCKS)).cast("int"))


def plan(narrow, shards=SHARDS, seed=17):
    """(block plan, {key: (size, target)}) from rows of (_key, _size, _hash, _block).

    The plan has one row per source and block: ``copies`` whole copies, ``part`` (the words it
    gives beyond these: all, none, or some at the border) and ``shards``, the shard of each.
    """
    spark = narrow.sparkSession
    blocks = narrow.groupBy("_key", "_block").agg(F.sum("_size").alias("words"))
    blocks = kept_once(blocks, "blocks")
    sums = blocks.groupBy("_key").agg(
        F.sum("words").alias("size"), F.count(F.lit(1)).alias("blocks")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {None if r["_key"] == "" else r["_key"][1:]: r["size"] for r in sums}
    wanted = targets(sizes)
    known, rows = {}, []
    for r in sums:
        source = None if r["_key"] == "" else r["_key"][1:]
        target = wanted[source]
        copies = int(target // r["size"]) if r["size"] else 0
        rest = int(target - copies * r["size"])
        known[r["_key"]] = (r["size"], float(target))
        rows.append((r["_key"], copies, rest))
    schema = "_key string, copies int, rest long"
    # One row per source, MAX_SOURCES at most.
    quota = F.broadcast(local_rows(spark, rows, schema))
    permuted = Window.partitionBy("_key").orderBy(F.xxhash64(F.lit(seed + 2), "_block"), "_block")
    before = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1))
    chosen = blocks.join(quota, "_key").withColumn("before", F.coalesce(before, F.lit(0))).withColumn(
        "part", F.least(F.col("words"), F.greatest(F.lit(0), F.col("rest") - F.col("before")))).drop("before", "rest")
    units = chosen.withColumn("copy", F.explode(F.sequence(
        F.lit(0), F.col("copies") - F.when(F.col("part") > 0, 0).otherwise(1), F.lit(1))))
    units = units.filter((F.col("copies") > 0) | (F.col("part") > 0))
    counted = {r["_key"]: r["n"] for r in units.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(counted)
    if shards is None:
        words = sum(target for _, target in known.values())
        shards = int(min(MOST_SHARDS, max(SHARDS, words // WORDS_PER_SHARD)))
    split = split_quotas([counted[k] for k in order], shards, seed)
    ends = local_rows(
        spark, [(k, [int(x) for x in row]) for k, row in zip(order, np.cumsum(split, axis=1))],
        "_key string, ends array<long>")
    drawn = Window.partitionBy("_key").orderBy(F.xxhash64(F.lit(seed + 3), "copy", "_block"), "copy", "_block")
    placed = units.join(F.broadcast(ends), "_key").withColumn("place", F.row_number().over(drawn)).withColumn(
        "shard", F.size(F.filter("ends", lambda e: e < F.col("place"))))
    shards_of = placed.groupBy("_key", "_block").agg(
        F.first("copies").alias("copies"), F.first("part").alias("part"), F.first("words").alias("words"),
        F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda s: s["shard"]).alias("shards"))
    return kept_once(shards_of, "plan"), known


def takes(rows, block_plan):
    """``rows`` with ``_shards`` (one per copy the mix takes) and ``_taken``, the words of a copy
    beyond ``_copies`` whole ones: all of the document's or none.

    In a block that is taken whole or not at all a row decides for itself; only the border block of
    a source is ordered by hash, to find the document at which the words run out. That document is
    taken if this comes nearer to the target than leaving it out.
    """
    if block_plan.count() <= BROADCAST_BLOCKS:
        block_plan = F.broadcast(block_plan)
    joined = rows.join(block_plan, ["_key", "_block"], "left").withColumns({
        "_copies": F.coalesce("copies", F.lit(0)), "part": F.coalesce("part", F.lit(0))})
    border = (F.col("part") > 0) & (F.col("part") < F.col("words"))
    plain = joined.filter(~F.coalesce(border, F.lit(False))).withColumn(
        "_taken", F.when(F.col("part") > 0, F.col("_size")).otherwise(F.lit(0)).cast("long"))
    order = Window.partitionBy("_key", "_block").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("part") - F.coalesce(F.sum("_size").over(order), F.lit(0))
    cut = joined.filter(border).withColumn("_taken", F.when(
        (left > 0) & (2 * left >= F.col("_size")), F.col("_size")).otherwise(F.lit(0)).cast("long"))
    return plain.unionByName(cut).withColumn("_shards", F.coalesce(
        F.slice("shards", F.lit(1), F.col("_copies") + F.when(F.col("_taken") > 0, 1).otherwise(0)),
        F.expr("cast(array() as array<int>)"))).drop("copies", "part", "words", "shards")


def amounts(docs, shards=SHARDS, seed=17):
    """Per document of (doc_id, source, text): size, source_size, target, taken, shards.

    ``taken`` counts the words the mix takes with repeats; a null text has no words, a null source
    is a source of its own. Sums per source come within half a document of the targets.
    """
    narrow = kept_once(sized(docs, seed).select("doc_id", "_key", "_size", "_hash", "_block"), "sized")
    block_plan, known = plan(narrow, shards, seed)
    per_source = local_rows(
        narrow.sparkSession, [(k, int(s), t) for k, (s, t) in known.items()], "_key string, source_size long, target double")
    return takes(narrow, block_plan).join(F.broadcast(per_source), "_key").select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_copies") * F.col("_size") + F.col("_taken")).cast("long").alias("taken"),
        F.array_join(F.transform("_shards", lambda s: s.cast("string")), ",").alias("shards"))


def mix(docs, shards=SHARDS, seed=17, shard="shard", place="place"):
    """The mixed corpus: a row for each copy of a document, with its ``shard`` and ``place`` (under
    these names or others).

    Keeps all columns of ``docs`` (with doc_id, source and text); texts are whole. Rows of a shard are shuffled by ``place``, a hash
    of the row and the copy. Columns with the names of these two are replaced. Repeated rows are mixed as
    rows of their own.
    """
    mine = [c for c in docs.columns if c.lower() not in (shard.lower(), place.lower())]
    # The row travels as one column, so that its names meet none of the plan's.
    full = sized(docs.select("doc_id", "source", "text", F.struct(*mine).alias("_row")), seed)
    narrow = kept_once(full.select("_key", "_size", "_hash", "_block"), "sized")
    block_plan, _ = plan(narrow, shards, seed)
    rows = takes(full, block_plan).select("*", F.posexplode("_shards").alias("_copy", "shard"))
    return rows.select(
        "_row.*", F.col("shard").alias(shard), F.xxhash64(F.lit(seed + 4), "_hash", "_copy").alias(place))


def shuffled(mixed, shard="shard", place="place"):
    """The mixed rows in shard files' order: one shard per partition at most, shuffled inside."""
    return mixed.repartition(shard).sortWithinPartitions(shard, place)
