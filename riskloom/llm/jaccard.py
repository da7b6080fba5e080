"""N-gram Jaccard join of whole texts by chosen paths.

Texts are sets of five-word shingles; equal sets are one row from the start. Each set is embedded
as 64 tokens (its minhashes at 64 places), so that two sets share about as large a part of the
tokens as their similarity. A run splits all sets on a few sampled tokens: those with the same
token share a bucket. Large buckets are split again, on places sampled for their path, until they
are small or until splitting saves no comparisons (their sets are alike); then they are compared
by brute force. Every set follows three sampled tokens at each split, which loses a pair of
similarity 0.8 in less than one of a hundred runs at any depth; three runs lose one in a million.

What brute force on tokens links are candidate groups. The shingles of their texts decide: within
each group all pairs are compared exactly, in blocks, by products of incidence matrices that leave
out the shingles of one text only. This gives the number of links of each text and the exact
classes. Pairs are never written out.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from riskloom.llm.blocks import flat, release, with_text_columns
from riskloom.llm.components import components
from riskloom.llm.scratch import discard, kept_once
from riskloom.llm.shingles import minhashes, shingle_sets

PLACES, RUNS, SAMPLED = 64, 3, 3
#: Tokens that candidates share: 5 standard deviations below what similarity 0.8 makes likely.
SHARED = 36
SMALL_BUCKET, BLOCK = 256, 8_192
#: Rows and shingles of one side of an exact comparison.
EXACT_ROWS, EXACT_TOKENS = 4_096, 3_000_000
#: Depth of the recursion; deeper buckets are compared in blocks, as alike ones are.
DEEPEST = 10
#: Rows (id and hash) up to which they are sent to every task instead of shuffling the texts.
BROADCAST_ROWS = 1_000_000
_COLUMNS = 2_048


def signatures(docs):
    """(doc_id, text_hash, key, n_shingles, tokens) per document; key null without words."""
    def block(texts):
        hashes, edges = shingle_sets(*flat(texts))
        places = minhashes(hashes, edges, PLACES)
        counts = np.diff(edges)
        keys = [xxhash.xxh128_digest(hashes[a:b].tobytes()) if b > a else None
                for a, b in zip(edges[:-1], edges[1:])]
        return [keys, counts, [row.astype("<u4").tobytes() for row in places]]

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return with_text_columns(
        rows, "key binary, n_shingles int, tokens binary", lambda: block, "text", ["text"])


def _token(place):
    return F.expr(f"substring(tokens, 4 * ({place}) + 1, 4)")


def _roots():
    """Path of each run's sampled places; all are different."""
    places = np.random.default_rng(41).permutation(PLACES)[:RUNS * SAMPLED]
    return F.array(*[F.xxhash64(F.lit(int(p)), _token(int(p))) for p in places])


def _children():
    """Paths that continue the path of a bucket at places sampled for it."""
    return [F.xxhash64("path", F.lit(j), _token(f"pmod(xxhash64(path, {j}), {PLACES})"))
            for j in range(SAMPLED)]


def _sized(rows):
    """``rows`` (path, key and more) of buckets with two rows or more, with their size."""
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(sizes, "path")


def spanning(tokens, shared=SHARED):
    """Links (row, row) that connect what all pairs sharing ``shared`` tokens would connect.

    A row is compared only with those that nothing has reached yet.
    """
    links, at, rest = [], np.arange(len(tokens)), tokens
    while len(at) > 1:
        queue, at, rest = [(at[0], rest[0])], at[1:], rest[1:]
        while queue and len(at):
            row, mine = queue.pop()
            hit = (rest == mine).sum(1) >= shared
            if hit.any():
                links += [(row, other) for other in at[hit]]
                queue += list(zip(at[hit], rest[hit]))
                at, rest = at[~hit], rest[~hit]
    return links


def _groups(batches, names):
    """Rows of consecutive equal leading columns (all but the last two), as lists."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        for row in zip(*columns):
            if row[0] != key:
                if rows:
                    yield rows
                key, rows = row[0], []
            rows.append(row)
    if rows:
        yield rows


def _candidates(buckets):
    """Links a, b within buckets given as (path, low, high, key, tokens) rows."""
    placed = buckets.withColumn("bucket", F.xxhash64("path", "low", "high")).select("bucket", "key", "tokens")

    def compare(batches):
        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

        left, right = [], []
        for rows in _groups(batches, ("bucket", "key", "tokens")):
            keys = [r[1] for r in rows]
            tokens = np.frombuffer(b"".join(r[2] for r in rows), "<u4").reshape(len(rows), PLACES)
            for a, b in spanning(tokens):
                left.append(keys[a])
                right.append(keys[b])
            if len(left) > 50_000:
                yield flush()
                left, right = [], []
        yield flush()

    return placed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, "a binary, b binary")


def _blocked(rows):
    """Rows of a large bucket dealt into blocks, once for every pair of blocks they belong to."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("mine", F.expr("cast(pmod(xxhash64(key), blocks) as int)"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "path", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "key", "tokens")


def candidate_links(sets):
    """Links between keys of ``sets`` (key, tokens) that share enough tokens, of all runs."""
    # Most sets share no root with any other: only those that do are given their tokens.
    rows = kept_once(_sized(sets.select(F.explode(_roots()).alias("path"), "key")).join(sets, "key"), "paths")
    found = []
    for depth in range(DEEPEST + 1):
        small = rows.filter(F.col("size") <= SMALL_BUCKET).select(
            "path", F.lit(0).alias("low"), F.lit(0).alias("high"), "key", "tokens")
        large = rows.filter(F.col("size") > SMALL_BUCKET)
        if not large.take(1):
            found.append(kept_once(_candidates(small), "links"))
            break
        # Comparisons left after a split, from counts by each sampled token.
        sizes = None
        for child in _children():
            counted = large.groupBy("path", child.alias("child")).agg(
                F.count(F.lit(1)).cast("double").alias("n"), F.first("size").cast("double").alias("size"))
            sizes = counted if sizes is None else sizes.unionByName(counted)
        work = sizes.groupBy("path").agg(
            F.sum(F.col("n") * F.col("n")).alias("after"), F.first("size").alias("size"))
        alike = F.lit(True) if depth == DEEPEST else F.col("after") >= F.col("size") * F.col("size")
        work = kept_once(work.select("path", alike.alias("alike")), "work")
        dense = large.join(work.filter("alike"), "path", "left_semi")
        found.append(kept_once(_candidates(small.unionByName(_blocked(dense))), "links"))
        open_ = work.filter("not alike")
        if not open_.take(1):
            break
        deeper = kept_once(_sized(large.join(open_, "path", "left_semi").select(
            F.explode(F.array(*_children())).alias("path"), "key", "tokens")), "paths")
        discard(rows, work)
        rows = deeper
    discard(rows)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def similar(left, right, same):
    """Boolean matrix of pairs with similarity 0.8 or more between lists of shingle arrays."""
    sizes_l, sizes_r = (np.array([len(t) for t in side]) for side in (left, right))
    everything = np.concatenate([*left, *([] if same else right)])
    values, where, counts = np.unique(everything, return_inverse=True, return_counts=True)
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[where]
    width = int((counts > 1).sum())
    row_l = np.repeat(np.arange(len(left)), sizes_l)
    cut = len(row_l)
    row_r = row_l if same else np.repeat(np.arange(len(right)), sizes_r)
    col_l, col_r = column[:cut], column[:cut] if same else column[cut:]
    shared = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, width, _COLUMNS):
        def slab(rows, columns, n):
            out = np.zeros((n, _COLUMNS), np.float32)
            inside = (columns >= first) & (columns < first + _COLUMNS)
            out[rows[inside], columns[inside] - first] = 1
            return out

        one = slab(row_l, col_l, len(left))
        shared += one @ (one if same else slab(row_r, col_r, len(right))).T
    alike = 9 * shared >= 4 * (sizes_l[:, None] + sizes_r[None, :])
    if same:
        np.fill_diagonal(alike, False)
    return alike


def forest(alike, same):
    """Pairs (left row, right row) that connect what the true entries of the matrix connect."""
    sides = (alike,) if same else (alike, alike.T)
    open_ = [np.ones(len(m), bool) for m in sides]
    links, k = [], len(sides)
    for first in range(len(alike)):
        if not open_[0][first]:
            continue
        open_[0][first] = False
        fronts = [np.array([first])] + [np.zeros(0, np.int64)] * (k - 1)
        while any(len(f) for f in fronts):
            after = [np.zeros(0, np.int64)] * k
            for side in range(k):
                other = (side + 1) % k
                if not len(fronts[side]):
                    continue
                seen = sides[side][fronts[side]] & open_[other]
                new = np.flatnonzero(seen.any(0))
                parents = fronts[side][seen[:, new].argmax(0)]
                links += list(zip(parents, new) if side == 0 else zip(new, parents))
                open_[other][new] = False
                after[other] = new
            fronts = after
    return links


def _exact(members):
    """(key, links, other): per text of a group (columns group_, low, high, mine, key, copies,
    shingles) its links inside a block pair, and pairs that connect the linked texts."""
    placed = members.withColumn("unit", F.xxhash64("root", "low", "high"))

    def compare(batches):
        keys, counts, others = [], [], []
        names = ("unit", "low", "high", "mine", "key", "copies", "shingles")
        for rows in _groups(batches, names):
            _, low, high = rows[0][:3]
            same = low == high
            # Rows that repeat id and text are one set: the first stands for all.
            rows = list({(r[3], r[4]): r for r in reversed(rows)}.values())
            left = [r for r in rows if r[3] == low]
            right = left if same else [r for r in rows if r[3] == high]
            if not left or not right or (same and len(left) < 2):
                continue
            alike = similar([np.frombuffer(r[6], "<u8") for r in left],
                            [np.frombuffer(r[6], "<u8") for r in right], same)
            for one, two, matrix in ((left, right, alike),) if same else ((left, right, alike), (right, left, alike.T)):
                weights = np.array([r[5] for r in two], np.int64)
                for row, mine in zip(one, matrix):
                    if mine.any():
                        keys.append(row[4])
                        counts.append(int(weights[mine].sum()))
                        others.append(None)
            for a, b in forest(alike, same):
                keys.append(left[a][4])
                counts.append(None)
                others.append(right[b][4])
            if len(keys) > 50_000:
                yield _exact_batch(keys, counts, others)
                keys, counts, others = [], [], []
        yield _exact_batch(keys, counts, others)
        release()

    return placed.select("unit", "low", "high", "mine", "key", "copies", "shingles").repartition(
        "unit").sortWithinPartitions("unit").mapInArrow(compare, "key binary, links long, other binary")


def _exact_batch(keys, counts, others):
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(others, pa.binary())],
        names=["key", "links", "other"])


def _shingled(rows):
    def block(texts):
        hashes, edges = shingle_sets(*flat(texts))
        return [[hashes[a:b].astype("<u8").tobytes() for a, b in zip(edges[:-1], edges[1:])]]

    return with_text_columns(rows, "shingles binary", lambda: block, "text", ["text"])


def classes(docs):
    """Per document of (doc_id, text): doc_id, text_hash, class_id, n_links, key, class_key.

    The class of a document is its connected component under links of similarity 0.8 or more;
    ``class_id`` is the least id in it, ``n_links`` counts the other documents it is linked to,
    equal ones included. Texts with fewer than five words are one shingle. A text without words (or
    null) is linked to none and has no keys. Repeated rows are documents of their own. A class whose
    ids are all null has a null id; ``class_key`` tells such classes apart.
    """
    docs = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    every = kept_once(signatures(docs), "signatures")
    sets = every.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "text_hash")).alias("sample"),
        F.max("n_shingles").alias("n_shingles"), F.max("tokens").alias("tokens"))
    sets = kept_once(sets, "sets")
    links = kept_once(candidate_links(sets.select("key", "tokens")), "candidates")
    groups = kept_once(components(links, "candidates"), "groups")
    discard(links)

    # Blocks of each group: as many as its rows and its shingles ask for.
    known = groups.join(sets.drop("tokens"), groups["node"] == sets["key"]).drop("node")
    sizes = known.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(EXACT_ROWS)),
        F.ceil(F.sum("n_shingles") / F.lit(EXACT_TOKENS))).cast("int").alias("blocks"))
    members = known.join(sizes, "root").select(
        "root", "blocks", "key", "copies", F.col("sample.doc_id").alias("_id"),
        F.col("sample.text_hash").alias("_hash"))
    members = kept_once(members, "members")
    discard(groups)
    texts = docs.withColumn("_text_hash", F.xxhash64("text"))
    chosen = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
    shingled = _shingled(texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["_id"]) & (
        texts["_text_hash"] == chosen["_hash"])).select("root", "blocks", "key", "copies", "text"))
    dealt = shingled.withColumn("mine", F.expr("cast(pmod(xxhash64(key), blocks) as int)")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    exact = kept_once(_exact(dealt.select(
        "root", F.least("mine", "with").alias("low"), F.greatest("mine", "with").alias("high"),
        "mine", "key", "copies", "shingles")), "exact")

    linked = exact.filter(F.col("links").isNotNull()).groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(exact.filter(F.col("other").isNotNull()).select(
        F.col("key").alias("a"), F.col("other").alias("b")), "classes")
    labelled = sets.select("key", "copies", "least").join(
        roots.withColumnRenamed("node", "key"), "key", "left").join(linked, "key", "left").withColumn(
        "class_key", F.coalesce("root", "key"))
    least = labelled.groupBy("class_key").agg(F.min("least").alias("class_id"))
    labelled = labelled.join(least, "class_key").select(
        "key", "class_key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return every.select("doc_id", "text_hash", "key").join(labelled, "key", "left").select(
        "doc_id", "text_hash",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "key", "class_key")


def join(docs):
    """doc_id, class_id and n_links of every document; see ``classes``."""
    return classes(docs).select("doc_id", "class_id", "n_links")


def one_of_each(docs):
    """The rows of ``docs`` (with doc_id and text) with one document of each class: the least
    (doc_id, text hash), a null id before others. Documents without words all stay."""
    found = kept_once(classes(docs), "classes")
    same = found.filter(F.col("key").isNotNull()).groupBy("class_key", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"))
    chosen = same.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    own = F.struct("doc_id", "text_hash") == F.col("one")
    # Rows that go, and those that repeat id and text, of which one stays.
    apart = kept_once(same.join(chosen, "class_key").filter(~own | (F.col("rows") > 1)).select(
        "doc_id", "text_hash", own.alias("stays")), "apart")
    discard(found)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].alias("id"),
                       F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("hash"))
    listed = F.broadcast(apart) if apart.count() <= BROADCAST_ROWS else apart
    on = rows["id"].eqNullSafe(listed["doc_id"]) & (rows["hash"] == listed["text_hash"])
    kept = rows.join(listed, on, "left_anti").select("row.*")
    repeated = apart.filter("stays")
    if not repeated.limit(1).count():
        return kept
    on = rows["id"].eqNullSafe(repeated["doc_id"]) & (rows["hash"] == repeated["text_hash"])
    return kept.unionByName(rows.join(repeated, on, "left_semi").dropDuplicates(["id", "hash"]).select("row.*"))
