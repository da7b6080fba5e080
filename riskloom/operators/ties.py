"""Mean ranks where values closer than ``eps`` to the first of their group share a rank.

Groups are anchored: walking upwards, a value at least ``eps`` above the current anchor becomes
the next one. That chain crosses bucket borders, so three steps keep it exact and parallel:
each bucket states which anchor it would hand on for the anchors it could receive; these step
functions are put together ``FAN`` at a time, up a tree and down again, which tells every bucket the
anchor it really receives; each bucket then walks from there. No task of the tree reads more than
``FAN`` rows. A bucket with a gap of ``eps`` hands on one anchor whatever it receives; only without
any gap its row lists several, as many as it has values at most.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from riskloom.operators import ranking as R
from riskloom.session import scratch_path

TIE_EPS = 1e-9
#: Step functions that one task puts together.
FAN = 64


def _next_anchor(p, eps):
    """For each position of the ascending ``p``: the first later one at least ``eps`` above."""
    here = np.arange(len(p))
    nxt = np.maximum(np.searchsorted(p, p + eps), here + 1)
    while True:  # p + eps may round; the difference itself decides
        early = (nxt < len(p)) & (p[np.minimum(nxt, len(p) - 1)] - p < eps)
        late = ~early & (nxt - 1 > here) & (p[nxt - 1] - p >= eps)
        if not (early.any() or late.any()):
            return nxt
        nxt = nxt + early - late


def _first_free(p, carry, eps):
    """Position of the first value that does not belong to the anchor ``carry``."""
    if np.isnan(carry):
        return 0
    return int(np.searchsorted(p - carry, eps))


def _handover(p, eps):
    """(first anchors, last anchors): entering at the first, a bucket leaves at the last."""
    nxt = _next_anchor(p, eps)
    gaps = np.flatnonzero(np.diff(p) >= eps)
    if len(gaps):  # behind a gap every chain is the same
        firsts = np.array([gaps[-1] + 1])
    else:
        firsts = np.arange(min(nxt[0] + 1, len(p)))
    # Pointer doubling: ``jump`` goes to the last anchor in twice as many steps each round.
    jump = np.where(nxt < len(p), np.minimum(nxt, len(p) - 1), np.arange(len(p)))
    while (jump[jump] != jump).any():
        jump = jump[jump]
    at = jump[firsts]
    keep = np.append(at[1:] != at[:-1], True)
    return p[firsts[keep]], p[at[keep]]


def _bucket_summary(groups, p, eps):
    def summarize(pdf):
        values = np.sort(pdf[p].to_numpy())
        table = _handover(values, eps)
        row = {g: [pdf[g].iloc[0]] for g in groups}
        row.update(
            bucket=[pdf["_bucket"].iloc[0]], rows=[int(pdf["n"].sum())],
            first=[values[0]], last=[values[-1]],
            enter=[table[0].tolist()], leave=[table[1].tolist()],
        )
        return pd.DataFrame(row)

    return summarize


def _walk(p, eps):
    def walk(pdf):
        pdf = pdf.sort_values(p, kind="stable").reset_index(drop=True)
        values = pdf[p].to_numpy()
        carry, start = float(pdf["_carry"].iloc[0]), int(pdf["_offset"].iloc[0])
        nxt = _next_anchor(values, eps).tolist()
        owner = np.full(len(values), -1)
        at = _first_free(values, carry, eps)
        while at < len(values):
            owner[at:nxt[at]] = at
            at = nxt[at]
        n = pdf["n"].to_numpy()
        pdf["anchor"] = np.where(owner >= 0, values[np.maximum(owner, 0)], carry)
        pdf["before"] = start + np.cumsum(n) - n
        return pdf.drop(columns=["_bucket", "_carry", "_offset"])

    return walk


def _received(row, carry, eps):
    """The anchor that a bucket, or a run of them, hands on when it receives ``carry``."""
    enter = np.asarray(row.enter)
    if np.isnan(carry):
        needed = row.first
    elif row.last - carry < eps:
        return carry  # all of it belongs to the anchor already open
    else:
        needed = enter[_first_free(enter, carry, eps)]
    return row.leave[int(np.searchsorted(enter, needed))]


def _compose(groups, eps):
    """One step function of the neighbouring ones of a part: same columns, same meaning."""
    def compose(pdf):
        rows = list(pdf.sort_values("bucket", kind="stable").itertuples(index=False))
        enter, leave = list(rows[0].enter), list(rows[0].leave)
        for before, row in zip(rows, rows[1:]):
            leave = [_received(row, x, eps) for x in leave]
            if before.last - rows[0].first < eps:  # an anchor may cover all so far and enter here
                enter, leave = [*enter, *row.enter], [*leave, *row.leave]
            keep = [i for i in range(len(enter)) if i + 1 == len(enter) or leave[i + 1] != leave[i]]
            enter, leave = [enter[i] for i in keep], [leave[i] for i in keep]
        out = {g: [pdf[g].iloc[0]] for g in groups}
        out.update(bucket=[int(pdf["parent"].iloc[0])], rows=[int(pdf["rows"].sum())],
                   first=[rows[0].first], last=[rows[-1].last], enter=[enter], leave=[leave])
        return pd.DataFrame(out)

    return compose


def _chain(groups, eps):
    """Per bucket of a part in order: the anchor it receives and the rows before it."""
    def follow(pdf):
        pdf = pdf.sort_values("bucket", kind="stable").reset_index(drop=True)
        carries, offsets = [], []
        carry, offset = float(pdf["_carry"].iloc[0]), int(pdf["_offset"].iloc[0])
        for r in pdf.itertuples(index=False):
            carries.append(carry)
            offsets.append(offset)
            carry = _received(r, carry, eps)
            offset += r.rows
        return pd.DataFrame({**{g: pdf[g] for g in groups}, "_bucket": pdf["bucket"],
                             "_carry": carries, "_offset": offsets})

    return follow


def _carries(summary, groups, eps, buckets):
    """What every bucket receives, for one summary row per group and bucket.

    Up: step functions of ``FAN`` neighbours become one, until ``FAN`` are left of a group. Down:
    each part follows the chain from the anchor its parent received.
    """
    fields = {f.name: f for f in summary.schema.fields}
    chained = T.StructType([fields[g] for g in groups] + [
        T.StructField("_bucket", T.IntegerType()), T.StructField("_carry", T.DoubleType()),
        T.StructField("_offset", T.LongType())])
    parent = (F.col("bucket") / FAN).cast("int")
    if buckets > FAN:  # read on every floor: computed once
        path = scratch_path(summary.sparkSession, "handovers")
        summary.write.parquet(path)
        summary = summary.sparkSession.read.schema(summary.schema).parquet(path)
    floors = [summary]
    while buckets > FAN:
        floors.append(floors[-1].withColumn("parent", parent).groupBy(*groups, "parent").applyInPandas(
            _compose(groups, eps), summary.schema))
        buckets = -(-buckets // FAN)
    top = floors[-1].withColumns({"_carry": F.lit(float("nan")), "_offset": F.lit(0).cast("bigint")})
    chain = top.groupBy(*(groups or [F.lit(0).alias("_all")])).applyInPandas(_chain(groups, eps), chained)
    for floor in reversed(floors[:-1]):
        above = chain.withColumnRenamed("_bucket", "parent")
        chain = floor.withColumn("parent", parent).join(above, [*groups, "parent"]).groupBy(
            *groups, "parent").applyInPandas(_chain(groups, eps), chained)
    return chain


def tie_members(scores, p="p", groups=(), eps=TIE_EPS, rows_per_bucket=R.ROWS_PER_BUCKET):
    """Distinct values with their ``anchor`` and the number of rows ``before`` them.

    ``scores``: one row per (groups, p) with the row count ``n``; other columns are kept.
    """
    groups = list(groups)
    _, cuts = R.cut_points(scores, p, rows_per_bucket)
    cuts = sorted(set(cuts))
    keys = groups + ["_bucket"]
    pieces = scores.withColumn("_bucket", R.bucket_of(F.col(p), cuts))
    if not cuts:  # nothing to hand over
        placed = pieces.withColumns({"_carry": F.lit(float("nan")), "_offset": F.lit(0).cast("bigint")})
    else:
        fields = {f.name: f for f in scores.schema.fields}
        doubles = T.ArrayType(T.DoubleType())
        summary_schema = T.StructType([fields[g] for g in groups] + [
            T.StructField("bucket", T.IntegerType()), T.StructField("rows", T.LongType()),
            T.StructField("first", T.DoubleType()), T.StructField("last", T.DoubleType()),
            T.StructField("enter", doubles), T.StructField("leave", doubles)])
        summary = pieces.select(*keys, p, "n").groupBy(*keys).applyInPandas(
            _bucket_summary(groups, p, eps), summary_schema)
        chain = _carries(summary, groups, eps, len(cuts) + 1)
        placed = pieces.join(chain, keys)
    out = T.StructType([f for f in scores.schema.fields] + [
        T.StructField("anchor", T.DoubleType()), T.StructField("before", T.LongType())])
    return placed.select(*scores.columns, "_bucket", "_carry", "_offset").groupBy(*keys).applyInPandas(
        _walk(p, eps), out)


def tie_average_rank(df, p="p", groups=(), eps=TIE_EPS, rows_per_bucket=R.ROWS_PER_BUCKET):
    """Per distinct value: its row count and the mean 1-based rank of its tie group."""
    groups = list(groups)
    scores = df.groupBy(*groups, p).agg(F.count(F.lit(1)).alias("n"))
    members = tie_members(scores, p, groups, eps, rows_per_bucket)
    ranked = members.groupBy(*groups, "anchor").agg(
        mean_rank(F.min("before"), F.sum("n")).alias("average_rank"))
    return members.join(ranked, [*groups, "anchor"]).select(*groups, p, "n", "average_rank")


def mean_rank(before, size):
    """Mean of the 1-based ranks ``before + 1 .. before + size``."""
    return (F.lit(2) * before + size + 1) / F.lit(2.0)
