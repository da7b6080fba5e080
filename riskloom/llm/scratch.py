"""Tables written once and read again, in the folder that the cluster shares."""

import contextlib
import weakref

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.session import remove_scratch, scratch_path

#: Bytes of a batch between Spark and Python where memory is short; Spark's own is 64 MB, held several
#: times on either side.
SMALL_BATCH = "2m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_PATHS = weakref.WeakKeyDictionary()


def kept_once(df, name):
    """``df`` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def discard(*tables):
    """Delete tables of ``kept_once`` that nothing will read again: what was made of them is written."""
    for table in tables:
        remove_scratch(table.sparkSession, _PATHS.pop(table))


def local_rows(spark, rows, ddl):
    """A table of few rows that the driver holds, tuples in the order of ``ddl``.

    They go to Spark as Arrow. From a list Spark makes an RDD, whose tasks run in Python workers of
    their own, beside those of the queries and as long-lived.
    """
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.table(
        [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema)], schema.fieldNames()), schema)


def small_batches_from_now(spark):
    """The session exchanges rows with Python in batches of ``SMALL_BATCH``, unless it was given a size.

    For tables that are computed later, where ``small_batches`` has ended.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, SMALL_BATCH)


@contextlib.contextmanager
def small_batches(spark):
    """What is computed inside exchanges rows with Python in batches of ``SMALL_BATCH``."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, SMALL_BATCH)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)
