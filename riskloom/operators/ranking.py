"""Global order without a global sort task.

A window without partitions would move every row to one task. Here the order is cut at
quantiles into buckets of bounded size; a bucket's rows are numbered on their own and start at
the number of rows in the buckets before it. Cut points enter the plan as literals, so a
recomputed task finds the same buckets. A value so frequent that it fills buckets by itself is
cut again by the tie column.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T, Window

ROWS_PER_BUCKET = 500_000
SKETCH_ROWS = 5_000_000
_GRID = 1024
_LAST_PART = 1_000_000


def quantiles(expression, size, top=False):
    """Aggregate: the inner ``size``-quantiles of a SQL expression (with ``top`` also the maximum).

    The grid is one parsed text: a thousand literals one by one would take a second of planning.
    """
    grid = ",".join(f"{i / size!r}D" for i in range(1, size + (1 if top else 0)))
    return F.expr(f"percentile_approx({expression}, array({grid}), {10 * size})")


def sketch_input(df, rows):
    """``df`` as it is, or of a large table the evenly drawn rows that suffice for quantiles.

    Quantiles only decide where work is cut; every row is processed wherever the cuts fall. All
    sketches meet in one task, so their number must not grow with the table.
    """
    return df if rows <= SKETCH_ROWS else df.sample(SKETCH_ROWS / rows, seed=7)


def thinned(cuts, buckets):
    """Of a fine grid of cut points, those that leave ``buckets`` even buckets."""
    if buckets <= 1:
        return []
    picks = sorted({max(1, round(i * (len(cuts) + 1) / buckets)) for i in range(1, buckets)})
    return [cuts[i - 1] for i in picks if i <= len(cuts)]


def _buckets_for(rows, rows_per_bucket):
    return max(1, math.ceil(rows / rows_per_bucket))


def _cuts_of_cuts(df, col, rows, buckets):
    """Cut points for more buckets than one grid has: each part of a grid is cut by its own."""
    parts = math.ceil(buckets / _GRID)
    first = sorted(set(sketch_input(df, rows).agg(quantiles(f"`{col}`", min(_GRID, parts * 2))).first()[0] or []))
    inner = math.ceil(buckets / (len(first) + 1))
    if inner <= 1:
        return first
    grids = sketch_input(df, rows).groupBy(bucket_of(F.col(col), first).alias("part")).agg(
        quantiles(f"`{col}`", min(inner, 16 * _GRID)).alias("cuts")).collect()
    return sorted([*first, *(c for r in grids for c in r["cuts"] or [])])


def cut_points(df, col, rows_per_bucket=ROWS_PER_BUCKET):
    """(row count, ascending cut points with repeats); none for a table of one bucket."""
    df = df.select(col)
    rows = df.count()
    buckets = _buckets_for(rows, rows_per_bucket)
    if buckets == 1:
        return rows, []
    if buckets > _GRID:
        return rows, _cuts_of_cuts(df, col, rows, buckets)
    cuts = sketch_input(df, rows).agg(quantiles(f"`{col}`", _GRID)).first()[0]
    return rows, thinned(list(cuts or []), buckets)


def bucket_of(col, cuts):
    """How many of the ascending ``cuts`` lie below ``col``, by binary search over whole batches.

    Declared nondeterministic, although it is not: the optimizer then infers no filters from it.
    Inferred on the other side of a join, such a filter would miss the column.
    """
    if not len(cuts):
        return F.lit(0)
    table = np.asarray(cuts)

    @F.arrow_udf(T.IntegerType())
    def count(values: pa.Array) -> pa.Array:
        found = np.searchsorted(table, values.fill_null(table[0].item()).to_numpy(zero_copy_only=False))
        return pa.array(np.where(values.is_null(), 0, found).astype(np.int32))

    return count.asNondeterministic()(col)


def _part_of(value, tie, hot):
    """For a hot value: 1 + how many of its cuts lie below the tie; null for others."""
    tables = {v: np.asarray(cuts) for v, cuts in hot.items()}

    @F.arrow_udf(T.IntegerType())
    def count(values: pa.Array, ties: pa.Array) -> pa.Array:
        x, t = (c.to_numpy(zero_copy_only=False) for c in (values, ties))
        out, known = np.zeros(len(x), np.int32), np.zeros(len(x), bool)
        for v, cuts in tables.items():
            here = x == v
            known |= here
            out[here] = 1 + (np.searchsorted(cuts, t[here]) if len(cuts) else 0)
        return pa.array(out, mask=~known)

    return count.asNondeterministic()(value, tie)


def _hot_value_cuts(df, order, tie, cuts, rows_per_bucket):
    """For each value that spans several buckets: ascending cut points of the tie column in it."""
    hot = sorted({c for i, c in enumerate(cuts) if i and c == cuts[i - 1]})
    if not hot:
        return {}
    inside = df.where(F.col(order).isin(hot)).select(F.col(order).alias("value"), F.col(tie).alias("tie"))
    counts = {r["value"]: r["n"] for r in inside.groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = sketch_input(inside, sum(counts.values()))
    parts = {v: _buckets_for(n, rows_per_bucket) for v, n in counts.items()}
    grids = {r["value"]: list(r["cuts"]) for r in drawn.groupBy("value").agg(
        quantiles("tie", max(_GRID, *parts.values())).alias("cuts")).collect()}
    return {v: thinned(grids.get(v, []), n) for v, n in parts.items()}


def bucketed(df, order, tie, ascending=True, rows_per_bucket=ROWS_PER_BUCKET):
    """``df`` with ``_bucket`` and ``_part``: bounded pieces, in the wanted global order."""
    _, cuts = cut_points(df, order, rows_per_bucket)
    hot = _hot_value_cuts(df, order, tie, cuts, rows_per_bucket)
    bucket = bucket_of(F.col(order), sorted(set(cuts)))
    # A hot value is the greatest of its bucket: last when ascending, first when descending.
    part = F.lit(0) if not hot else F.coalesce(
        _part_of(F.col(order), F.col(tie), hot), F.lit(0 if ascending else _LAST_PART))
    return df.withColumns({"_bucket": bucket if ascending else -bucket, "_part": part})


def running_totals(df, order, tie, sums=None, ascending=True, groups=(), rank="rank",
                   rows_per_bucket=ROWS_PER_BUCKET):
    """Adds the 1-based global ``rank`` and, per entry of ``sums``, the running total up to the row.

    Order is (``order``, then ``tie`` ascending); ``groups`` are ranked separately.
    """
    groups, sums = list(groups), dict(sums or {})
    pieces = bucketed(df, order, tie, ascending, rows_per_bucket)
    keys = groups + ["_bucket", "_part"]
    totals = pieces.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"_before_{rank}"),
        *[F.sum(col).alias(f"_before_{name}") for name, col in sums.items()],
    )
    # One row per piece and group, each standing for ``rows_per_bucket`` rows.
    one_group = [F.col("_bucket") * 0]
    earlier = Window.partitionBy(*(groups or one_group)).orderBy("_bucket", "_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[
        F.coalesce(F.sum(f"_before_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}")
        for n in [rank, *sums]
    ])
    within = Window.partitionBy(*keys).orderBy(
        F.col(order).asc() if ascending else F.col(order).desc(), F.col(tie).asc())
    to_row = within.rowsBetween(Window.unboundedPreceding, 0)
    numbered = {rank: F.row_number().over(within) + F.col(f"_before_{rank}")}
    for name, col in sums.items():
        numbered[name] = F.sum(col).over(to_row) + F.col(f"_before_{name}")
    return pieces.join(offsets, keys).select(
        *df.columns, *[col.alias(name) for name, col in numbered.items()]
    )


def distributed_rank(df, order, tie=None, ascending=True, groups=(), rank="rank",
                     rows_per_bucket=ROWS_PER_BUCKET):
    """Global row number by (``order``, ``tie``)."""
    return running_totals(df, order, tie or order, None, ascending, groups, rank, rows_per_bucket)
