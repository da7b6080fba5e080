"""Stratified train/test split with an exact number of rows per class."""

from pyspark.sql import functions as F, Window

from riskloom.schemas import LABEL

_DIGITS = 4  # hex digits per step: 65,536 even parts
BORDER_ROWS = 100_000


def shuffle_key(key, seed):
    """The position of a row in the seeded shuffle of its class."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def _inside(rows, found):
    """Rows whose hash starts with the prefix of their class in {class: (prefix, take)}."""
    condition = F.lit(False)
    for c, (prefix, _) in found.items():
        condition = condition | ((F.col("_class") == c) & F.col("_hash").startswith(prefix))
    return rows.where(condition)


def stratified_split(df, frac=0.8, seed=42, key="customer_id", label=LABEL):
    """Adds ``is_train``: in each class the first ``round(frac * n)`` rows of the shuffle.

    Rows are never ranked as a whole. Counting by hash prefix finds, per class, the one prefix in
    which the quota runs out; it is counted again by a longer prefix until few rows share it, and
    only these are numbered to find the last hash still in. What is broadcast is one row per
    class (two).
    """
    rows = df.select(
        F.when(F.col(label) == 1, 1).otherwise(0).alias("_class"),
        shuffle_key(F.col(key), seed).alias("_hash"),
    )
    by_class = Window.partitionBy("_class")
    digits, quota, found = 0, None, {}
    while True:
        digits += _DIGITS
        here = rows if quota is None else _inside(rows, found)
        counts = here.groupBy("_class", F.substring("_hash", 1, digits).alias("_prefix")).agg(
            F.count(F.lit(1)).alias("_n"))
        if quota is None:
            left = F.round(F.sum("_n").over(by_class) * F.lit(frac)).cast("bigint")
        else:
            left = F.element_at(F.create_map(*[F.lit(x) for c, (_, take) in found.items() for x in (c, take)]),
                                F.col("_class"))
        up_to = by_class.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
        border = (
            counts.select("_class", "_prefix", "_n", F.sum("_n").over(up_to).alias("_upto"), left.alias("_quota"))
            .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
            .select("_class", "_prefix", "_n", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
        ).collect()  # two rows
        quota = True
        found = {r["_class"]: (r["_prefix"], r["_take"]) for r in border}
        if digits >= 32 or all(r["_n"] <= BORDER_ROWS for r in border):
            break
    takes = F.create_map(*[F.lit(x) for c, (_, take) in found.items() for x in (c, take)]) if found else None
    last_in = (
        _inside(rows, found).withColumn("_rn", F.row_number().over(by_class.orderBy("_hash")))
        .where(F.col("_rn") == F.element_at(takes, F.col("_class"))).select("_class", F.col("_hash").alias("_last"))
    ) if found else rows.select("_class", F.col("_hash").alias("_last")).limit(0)
    marked = df.withColumns({
        "_class": F.when(F.col(label) == 1, 1).otherwise(0), "_hash": shuffle_key(F.col(key), seed)})
    return marked.join(F.broadcast(last_in), "_class", "left").select(
        *df.columns, F.coalesce(F.col("_hash") <= F.col("_last"), F.lit(False)).alias("is_train"))
