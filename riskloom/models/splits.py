"""Best split per node from value statistics, as one SQL statement per step.

``stats`` has one row per (node keys, feature, value) with ``cnt`` rows, ``wgt`` weight and
``pos`` positive weight; ``feature`` is the position in the order in which features are tried.
Weighted impurities are mixed by row counts. The text form keeps planning short, because a tree
asks for these plans once per level.

Where a feature may have more values than one task should sort, each value also has a ``bucket``,
a range of the feature's values. Values are then numbered and summed within buckets, and the totals
of the buckets before are added: the candidates are those of one window over the whole feature.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.functions.memory import release
from riskloom.operators import ranking as R

TARGET_CANDIDATES = 15
GAIN_DIGITS = 12
# Cut points that one sketch of a feature gives.
GRID = 1024
MIN_GAIN = 1e-7


def _candidates(source, keys, target):
    node = ", ".join([*keys, "feature"])
    return f"""
    SELECT * FROM (
      SELECT *,
        row_number() OVER up_to AS rn, count(*) OVER node AS distinct_values,
        sum(cnt) OVER up_to AS left_cnt, sum(wgt) OVER up_to AS left_wgt, sum(pos) OVER up_to AS left_pos,
        sum(cnt) OVER node AS node_cnt, sum(wgt) OVER node AS node_wgt, sum(pos) OVER node AS node_pos
      FROM {source}
      WINDOW up_to AS (PARTITION BY {node} ORDER BY value ROWS UNBOUNDED PRECEDING),
             node AS (PARTITION BY {node})
    ) WHERE (rn - 1) % greatest(distinct_values DIV {target}, 1) = 0"""


def _impurity(pos, wgt):
    share = f"({pos}) / ({wgt})"
    return f"CASE WHEN {wgt} > 0 THEN 1 - (pow({share}, 2) + pow(1 - {share}, 2)) ELSE 0D END"


def _gains(candidates):
    left = _impurity("left_pos", "left_wgt")
    right = _impurity("node_pos - left_pos", "node_wgt - left_wgt")
    return f"""
    SELECT *, CASE WHEN node_cnt > left_cnt THEN round({_impurity('node_pos', 'node_wgt')}
        - (left_cnt * {left} + (node_cnt - left_cnt) * {right}) / node_cnt, {GAIN_DIGITS})
      ELSE -1D END AS gain
    FROM ({candidates})"""


_BEST = "value, gain, left_cnt, left_wgt, left_pos, node_cnt, node_wgt, node_pos"


def split_candidates(stats, keys=(), target=TARGET_CANDIDATES):
    """Every ``max(L div target, 1)``-th of the L ascending values of a feature in a node.

    Adds the running sums up to the value and the node totals, all in one window pass.
    """
    return stats.sparkSession.sql(_candidates("{stats}", keys, target), stats=stats)


def split_gains(candidates):
    """Adds ``gain``; the last value of a node leaves nothing to its right and gets -1."""
    return candidates.sparkSession.sql(_gains("SELECT * FROM {candidates}"), candidates=candidates)


def _bucketed_candidates(source, keys, target):
    node = ", ".join([*keys, "feature"])
    sums = ("cnt", "wgt", "pos")
    before = ", ".join(f"coalesce(sum({c}) OVER earlier, 0) AS before_{c}" for c in ("n", *sums))
    whole = ", ".join(f"sum({c}) OVER node AS node_{c}" for c in ("n", *sums))
    return f"""
    SELECT * FROM (
      SELECT {node}, value, rn + before_n AS rn, node_n AS distinct_values, node_cnt, node_wgt, node_pos,
        {", ".join(f"inner_{c} + before_{c} AS left_{c}" for c in sums)}
      FROM (
        SELECT {node}, bucket, value, row_number() OVER up_to AS rn,
          {", ".join(f"sum({c}) OVER up_to AS inner_{c}" for c in sums)}
        FROM {source}
        WINDOW up_to AS (PARTITION BY {node}, bucket ORDER BY value ROWS UNBOUNDED PRECEDING))
      JOIN (
        SELECT {node}, bucket, {before}, {whole}
        FROM (SELECT {node}, bucket, count(*) AS n, {", ".join(f"sum({c}) AS {c}" for c in sums)}
              FROM {source} GROUP BY {node}, bucket)
        WINDOW earlier AS (PARTITION BY {node} ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               node AS (PARTITION BY {node}))
      USING ({node}, bucket)
    ) WHERE (rn - 1) % greatest(distinct_values DIV {target}, 1) = 0"""


def best_splits(partials, keys=(), target=TARGET_CANDIDATES, bucketed=False):
    """One row per (keys, feature): its best candidate, lowest threshold on equal gain.

    ``partials`` may hold several rows per value; they are added up first, on the map side too.
    With ``bucketed`` it has the column ``bucket``. The caller takes the first feature with the
    greatest gain per node.
    """
    node = ", ".join([*keys, "feature"])
    place = f"{node}, bucket" if bucketed else node
    merged = f"""(SELECT {place}, value, sum(cnt) AS cnt, sum(wgt) AS wgt, sum(pos) AS pos
      FROM {{partials}} GROUP BY {place}, value)"""
    candidates = (_bucketed_candidates if bucketed else _candidates)(merged, keys, target)
    return partials.sparkSession.sql(f"""
    SELECT {node}, best.* FROM (
      SELECT {node}, max_by(struct({_BEST}), struct(gain, -value)) AS best
      FROM ({_gains(candidates)}) GROUP BY {node})""", partials=partials)


# --- runs of values ------------------------------------------------------------------------------

RUNS = T.StructType([
    T.StructField("slot", T.IntegerType()), T.StructField("feature", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("data", T.BinaryType()),
])
_SUMS = ("cnt", "wgt", "pos")
#: Values that a merging task gets on average, at most; and how many it holds of a key before it merges them.
TASK_VALUES, MERGE_VALUES = 4_000_000, 1_000_000
_MERGED = T.StructType([*RUNS, T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in _SUMS]])
_BEST_ROW = T.StructType([
    T.StructField("slot", T.IntegerType()), T.StructField("feature", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in _BEST.split(", ")]])


def packed_run(value, cnt, wgt, pos):
    """Ascending values with their sums as one binary value."""
    return np.stack([value, cnt, wgt, pos]).astype(np.float64).tobytes()


def _merge(parts):
    """One run of the runs of several tasks: (4, values)."""
    runs = [np.frombuffer(p).reshape(4, -1) for p in parts]
    if len(runs) == 1:
        return runs[0]
    together = np.concatenate(runs, axis=1)
    together = together[:, np.argsort(together[0], kind="stable")]
    first = np.flatnonzero(np.r_[True, together[0, 1:] != together[0, :-1]])
    return np.vstack([together[:1, first], np.add.reduceat(together[1:], first, axis=1)])


def _gini(pos, wgt):
    share = np.divide(pos, wgt, out=np.zeros_like(pos), where=wgt > 0)
    return np.where(wgt > 0, 1 - (share ** 2 + (1 - share) ** 2), 0.0)


def _best_in_run(run, before, node, target):
    """The best candidate of a run: the values in ``_BEST``, or None without a candidate.

    ``before`` and ``node`` are (values, cnt, wgt, pos) ahead of the run and of the whole node.
    """
    step = max(int(node[0]) // target, 1)
    at = np.arange(-int(before[0]) % step, run.shape[1], step)
    if not len(at):
        return None
    cnt, wgt, pos = (np.cumsum(run[i])[at] + before[i] for i in (1, 2, 3))
    _, node_cnt, node_wgt, node_pos = (np.array([float(x)]) for x in node)
    mixed = (cnt * _gini(pos, wgt) + (node_cnt - cnt) * _gini(node_pos - pos, node_wgt - wgt)) / node_cnt
    gain = np.where(cnt < node_cnt, np.round(_gini(node_pos, node_wgt) - mixed, GAIN_DIGITS), -1.0)
    top = int(np.argmax(gain))
    return [run[0, at[top]], gain[top], cnt[top], wgt[top], pos[top], node_cnt[0], node_wgt[0], node_pos[0]]


def _keyed(batches, keys):
    """(key, merged run) of consecutive rows with equal keys.

    Runs are read in place and merged whenever they have ``MERGE_VALUES`` more values than the last
    merged run, so a key takes the memory of its distinct values, not of its runs.
    """
    held, fresh, key = [], 0, None
    for batch in batches:
        places = zip(*[batch.column(k).to_pylist() for k in keys])
        for here, data in zip(places, batch.column("data")):
            if here != key:
                if held:
                    yield key, _merge(held)
                held, fresh, key = [], 0, here
            held.append(data.as_buffer())
            fresh += held[-1].size // 32
            if fresh >= MERGE_VALUES:
                held, fresh = [_merge(held).tobytes()], 0
    if held:
        yield key, _merge(held)


def _batched(rows, schema, size=2_000):
    """Record batches of the given rows."""
    kinds = [to_arrow_type(f.dataType) for f in schema]
    for part in iter(lambda: list(itertools.islice(rows, size)), []):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(zip(*part), kinds)], names=schema.fieldNames())


def _best_of_nodes(target):
    def run(batches):
        def rows():
            for key, merged in _keyed(batches, ("slot", "feature")):
                node = (merged.shape[1], *merged[1:].sum(axis=1))
                yield (*key, *_best_in_run(merged, (0, 0.0, 0.0, 0.0), node, target))

        yield from _batched(rows(), _BEST_ROW)
        release()

    return run


def _merged_buckets(batches):
    def rows():
        for key, merged in _keyed(batches, ("slot", "feature", "bucket")):
            yield (*key, merged.tobytes(), merged.shape[1], *merged[1:].sum(axis=1))

    # A row is a whole bucket: one at a time.
    yield from _batched(rows(), _MERGED, 1)
    release()


def _best_of_buckets(target):
    def run(batches):
        def rows():
            for r in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                merged = np.frombuffer(r["data"]).reshape(4, -1)
                before, node = ([r[f"{side}_{c}"] for c in ("n", *_SUMS)] for side in ("before", "node"))
                best = _best_in_run(merged, before, node, target)
                if best is not None:
                    yield (r["slot"], r["feature"], *best)

        yield from _batched(rows(), _BEST_ROW)
        release()

    return run


def best_of_runs(runs, target=TARGET_CANDIDATES, bucketed=False, values=0):
    """Per (slot, feature) the row that ``best_splits`` has, from rows of RUNS: the same candidates; collected.

    A task's values of a node and feature travel as one binary run, so that Spark shuffles and sorts
    runs and numpy merges them. With buckets (each a bounded part of a feature's values) runs merge
    per bucket, totals of the buckets before are added, and the best of all buckets is taken. Merged runs
    are kept for that: their totals and their candidates would each make and shuffle all runs. ``values``
    is how many values the runs may have together: many of them are dealt to so many tasks that a
    task's share is bounded.
    """
    tasks = math.ceil(values / TASK_VALUES)
    many = [tasks] if tasks > int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    node = ["slot", "feature"]
    if not bucketed:
        return runs.repartition(*many, *node).sortWithinPartitions(*node).mapInArrow(
            _best_of_nodes(target), _BEST_ROW).collect()
    place = [*node, "bucket"]
    merged = runs.repartition(*many, *place).sortWithinPartitions(*place).mapInArrow(
        _merged_buckets, _MERGED).persist(StorageLevel.MEMORY_AND_DISK)
    whole = Window.partitionBy(*node)
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = merged.select(*place, "n", *_SUMS)
    offsets = totals.select(
        *place, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in ("n", *_SUMS)],
        *[F.sum(c).over(whole).alias(f"node_{c}") for c in ("n", *_SUMS)])
    best = merged.select(*place, "data").join(offsets, place).mapInArrow(_best_of_buckets(target), _BEST_ROW)
    columns = F.struct(*_BEST_ROW.fieldNames()[2:])
    try:
        return best.groupBy(*node).agg(F.max_by(columns, F.struct("gain", -F.col("value"))).alias("best")).select(
            *node, "best.*").collect()
    finally:
        merged.unpersist()


def value_cuts(long, width, rows_per_bucket=R.ROWS_PER_BUCKET):
    """Per feature the ascending cut points of its buckets; None if every feature fits one.

    ``long`` has a row per (feature, value). All features are sketched in the same aggregation: a
    task's sketches merge feature by feature, each feature in a task of its own. More buckets than a
    grid has points come from a second aggregation that sketches every part of the first grid.
    """
    rows = {r["feature"]: r["n"] for r in long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = {f: math.ceil(n / rows_per_bucket) for f, n in rows.items()}
    most = max(buckets.values(), default=1)
    if most <= 1:
        return None
    drawn = R.sketch_input(long, max(rows.values()))
    first = _grids(drawn, ["feature"], GRID)
    if most <= GRID:
        return [sorted(set(R.thinned(first.get((f,), []), buckets.get(f, 1)))) for f in range(width)]
    coarse = [sorted(set(first.get((f,), []))) for f in range(width)]
    parts = drawn.withColumn("part", _bucket_by_feature(F.col("feature"), F.col("value"), coarse))
    inner = _grids(parts, ["feature", "part"], math.ceil(most / GRID))
    finer = [[] for _ in range(width)]
    for (feature, _), cuts in inner.items():
        finer[feature] += cuts
    return [sorted({*c, *f}) for c, f in zip(coarse, finer)]


def _grids(long, keys, size):
    """Inner quantiles of the values of each key."""
    found = long.groupBy(*keys).agg(R.quantiles("value", size).alias("cuts")).collect()
    return {tuple(r[k] for k in keys): list(r["cuts"] or []) for r in found}


def _bucket_by_feature(feature, value, cuts):
    tables = [np.asarray(c, dtype=float) for c in cuts]

    @F.arrow_udf(T.IntegerType())
    def bucket(features: pa.Array, values: pa.Array) -> pa.Array:
        f, v = features.to_numpy(), values.to_numpy(zero_copy_only=False).astype(float)
        out = np.zeros(len(f), np.int32)
        for j, table in enumerate(tables):
            here = f == j
            out[here] = np.searchsorted(table, v[here])
        return pa.array(out)

    return bucket.asNondeterministic()(feature, value)


def best_split(df, features, label="y", weight=None, target=TARGET_CANDIDATES,
               rows_per_bucket=R.ROWS_PER_BUCKET):
    """The best split of one node: feature name, threshold, gain (no row when nothing splits)."""
    wgt = F.col(weight).cast("double") if weight else F.lit(1.0)
    # Summed by value before anything else: the input is read once, and what is sketched, bucketed
    # and sorted is one row per value.
    long = df.select(
        F.lit(1).alias("cnt"), wgt.alias("wgt"),
        F.when(F.col(label) == 1, wgt).otherwise(F.lit(0.0)).alias("pos"),
        F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("feature", "value"),
    ).groupBy("feature", "value").agg(*[F.sum(c).alias(c) for c in ("cnt", "wgt", "pos")]).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        cuts = value_cuts(long, len(features), rows_per_bucket)
        if cuts:
            long = long.withColumn("bucket", _bucket_by_feature(F.col("feature"), F.col("value"), cuts))
        best = best_splits(long, (), target, bool(cuts)).collect()  # one row per feature
    finally:
        long.unpersist()
    return _winner(df.sparkSession, best, features)


def _winner(spark, best, features):
    """The first feature with the greatest gain, as a table of one row or none."""
    fit = [r for r in best if r["gain"] is not None and r["gain"] > MIN_GAIN]
    top = sorted(fit, key=lambda r: (-r["gain"], r["feature"]))[:1]
    return spark.createDataFrame(
        [(features[r["feature"]], r["value"], r["gain"], r["left_cnt"], r["node_cnt"]) for r in top],
        "feature string, threshold double, gain double, left_rows long, node_rows long")
