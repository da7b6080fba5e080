"""Typed mart tables: inserts that keep existing rows, the append-only score log, Parquet."""

from pyspark.errors import AnalysisException
from pyspark.sql import Window, functions as F

from riskloom.operators import ranking as R
from riskloom.schemas import MART_SCORES
from riskloom.session import scratch_path

#: Partitions whose row counts go to every task.
BROADCAST_PARTS = 200_000


def rows_absent(new, target, key="customer_id"):
    """Rows of ``new`` whose key is not in ``target``."""
    return new.join(target.select(key).distinct(), key, "left_anti")


def insert_if_absent(target, new, key="customer_id", order=None):
    """``target`` plus the new keys. Existing rows win; within the batch the first by ``order``.

    Without ``order`` the batch must already be unique by key.
    """
    if order is not None:
        payload = [c for c in new.columns if c not in (key, order)]
        new = (
            new.groupBy(key).agg(F.min_by(F.struct(*payload), F.col(order)).alias("first"))
            .select(key, "first.*")
        )
    return target.unionByName(rows_absent(new, target, key).select(*target.columns))


def new_scores(new, model_version, start=0, scored_at=None, order="customer_id", tie=None,
               rows_per_bucket=R.ROWS_PER_BUCKET):
    """Rows for the score log: surrogate ids go on from ``start``, without gaps.

    Rows of one customer are numbered by ``tie``, by default a hash of the whole row, which also
    splits a customer with very many new scores over several tasks.
    """
    if tie is None:
        new, tie = new.withColumn("_tie", F.xxhash64(*new.columns)), "_tie"
    numbered = R.distributed_rank(new, order, tie, rank="_rank", rows_per_bucket=rows_per_bucket)
    when = F.current_timestamp() if scored_at is None else F.lit(scored_at).cast("timestamp")
    return typed(numbered.withColumns({
        "score_id": F.col("_rank") + start,
        "model_version": F.lit(model_version),
        "scored_at": when,
    }), MART_SCORES)


def append_scores(log, new, model_version, scored_at=None, order="customer_id", tie=None,
                  rows_per_bucket=R.ROWS_PER_BUCKET):
    """The log with ``new`` added; see :func:`new_scores`."""
    start = log.agg(F.coalesce(F.max("score_id"), F.lit(0))).scalar()
    added = new_scores(new, model_version, start, scored_at, order, tie, rows_per_bucket)
    return log.unionByName(added.select(*log.columns))


def typed(df, schema):
    """``df`` with the columns, order and types of ``schema`` (decimals are rounded)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def in_order(df, column, start=0):
    """(``df`` with ``column``, number of rows): numbers from ``start`` + 1, by partition and row.

    The rows are written once with their place in their task's partition; the counts of the
    partitions before are added when they are read again. Nothing is sorted or shuffled.
    """
    path = scratch_path(df.sparkSession, "numbered")
    df.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).persist()
    rows, parts = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    # One row per task that wrote.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if parts <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    numbered = placed.withColumn("_part", part).join(offsets, "_part").select(
        (F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + start).alias(column), *df.columns)
    return numbered, rows


def id_start(spark, root, name, load, rows):
    """The last id before a load's own ids, from a small table of id blocks beside the marts.

    A block (first id, rows) per table and load is kept under ``root``, so that no log is read to go
    on with its ids. A load that is repeated keeps its block if its rows fit it or nothing follows it;
    else it gets a new one. One load writes at a time.
    """
    table = f"{root}/_id_blocks"
    schema = "first long, rows long, table string, load int"
    try:
        blocks = spark.read.schema(schema).parquet(table).where(F.col("table") == name).collect()  # a row per load
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        blocks = []
    own = next((b for b in blocks if b["load"] == load), None)
    end = max((b["first"] + b["rows"] for b in blocks if b["load"] != load), default=1)
    first = own["first"] if own and (own["first"] >= end or rows <= own["rows"]) else end
    spark.createDataFrame([(first, rows)], "first long, rows long").coalesce(1).write.mode("overwrite").parquet(
        f"{table}/table={name}/load={load}")
    return first - 1


def _checked(field, length):
    column = F.col(field.name)
    if length is not None:
        column = F.when(F.length(column) > length, F.raise_error(F.lit(
            f"{field.name} is longer than {length}")).cast(field.dataType)).otherwise(column)
    if not field.nullable:
        column = F.coalesce(column, F.raise_error(F.lit(f"{field.name} is NULL")).cast(field.dataType))
    return column.alias(field.name)


def write_mart(df, path, schema, partition_cols=(), mode="overwrite", lengths=None):
    """Write ``df`` as a typed Parquet table. A NULL in a required column fails the write, and so
    does a text longer than ``lengths`` allows its column."""
    table = typed(df, schema)
    checked = table.select(*[_checked(f, (lengths or {}).get(f.name)) for f in schema.fields])
    checked.write.mode(mode).partitionBy(*partition_cols).parquet(path)
    return df.sparkSession.read.parquet(path)
