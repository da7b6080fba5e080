"""What all models share: the probability column and the training table on the executors."""

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import functions as F, types as T

from riskloom.functions.memory import release
from riskloom.functions.probability import hard_predict, stable_sigmoid
from riskloom.operators.aggregates import class_weights
from riskloom.schemas import FEATURES, LABEL
from riskloom.session import remove_scratch, scratch_path

PROBABILITY = "probability_of_default"
ROWS_PER_TASK = 100_000
BLOCK_ROWS = 4_096
BLOCKS = T.StructType([T.StructField(n, T.BinaryType()) for n in ("y", "x", "draws")])
ROWS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("y", T.DoubleType()),
    T.StructField("x", T.ArrayType(T.DoubleType())),
])


class Model:
    """``transform(df)`` adds ``probability_of_default``; ``importances()`` has one share per feature."""

    name = "model"

    def probability(self):
        """The probability as a column over the feature columns."""
        return stable_sigmoid(self.log_odds())

    def log_odds(self):
        """For models with a logistic link: its argument as a column, else None."""
        return None

    def importances(self):
        raise NotImplementedError

    def transform(self, df, probability=PROBABILITY):
        z = self.log_odds()
        if z is None:
            return df.withColumn(probability, self.probability())
        # The link looks at its argument three times: compute it once, as a column of its own.
        return df.withColumn("_log_odds", z).withColumn(
            probability, stable_sigmoid(F.col("_log_odds"))).drop("_log_odds")

    def predict(self, df, threshold=0.5, prediction="prediction"):
        return df.withColumn(prediction, hard_predict(self.probability(), threshold))


def shares(values):
    """Values divided by their sum; uniform if that is 0."""
    total = sum(values)
    if total > 0:
        return [v / total for v in values]
    return [1.0 / len(values)] * len(values)


class TrainingTable:
    """Feature vector and label of each row, written once; iterative fits keep them as blocks.

    The table goes to the shared scratch folder: the many small jobs of a fit then plan from one
    scan instead of the whole history of the input, and what a lost executor kept is read again
    from there. ``keep`` packs a few thousand rows into one binary value each, so that a pass
    hands whole matrices to the tasks instead of converting row by row. As a context manager it
    deletes its table at the end, also after an error.
    """

    def __init__(self, df, names=FEATURES, label=LABEL, key="customer_id"):
        self.names = list(names)
        spark = df.sparkSession
        self.path = path = scratch_path(spark, "training")
        df.select(
            F.col(key).cast("bigint").alias("id"),
            F.when(F.col(label) == 1, 1.0).otherwise(0.0).alias("y"),
            F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))) for n in self.names]).alias("x"),
        ).write.parquet(path)
        stored = spark.read.schema(ROWS).parquet(path)
        self.counts = class_weights(stored, "y").first()
        if not self.counts["samples"]:
            remove_scratch(spark, path)
            raise ValueError("no training rows")
        # Small tables in few tasks save scheduling. A scan of few files or row groups is dealt out: a
        # task holds its rows as one batch of blocks, which must not grow with the table.
        self.tasks = math.ceil(self.counts["samples"] / ROWS_PER_TASK)
        few = stored.rdd.getNumPartitions() < self.tasks
        self.rows = stored.repartition(self.tasks) if few else stored.coalesce(self.tasks)
        self.blocks = None

    @property
    def prior_log_odds(self):
        return math.log(self.counts["n_pos"] / self.counts["n_neg"])

    def deal(self, tasks):
        """Deal the rows evenly to ``tasks`` tasks."""
        self.tasks = tasks
        self.rows = self.rows.repartition(tasks)

    def columns(self):
        """The features as columns again."""
        return self.rows.select(*[F.get("x", F.lit(j)).alias(n) for j, n in enumerate(self.names)])

    def keep(self, transform, draws=None):
        """Keep blocks of the transformed matrix on the executors.

        ``transform``: (rows, features) matrix to the matrix kept. ``draws``: optional array column.
        """
        self.blocks = self.packed(transform, draws).persist(StorageLevel.MEMORY_AND_DISK)
        return self.blocks

    def packed(self, transform, draws=None):
        """The blocks, not kept."""
        rows = self.rows if draws is None else self.rows.withColumn("draws", draws)
        return rows.drop("id").mapInArrow(_pack(transform, len(self.names), draws is not None), BLOCKS)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        if self.blocks is not None:
            self.blocks.unpersist()
        remove_scratch(self.rows.sparkSession, self.path)


def _matrix(column):
    """An Arrow list column with equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pack(transform, width, has_draws):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = np.ascontiguousarray(transform(_matrix(part.column("x"))))
                y = part.column("y").to_numpy().astype(np.uint8)
                draws = _matrix(part.column("draws")).astype(np.uint8).tobytes() if has_draws else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([y.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                     pa.array([draws], pa.binary())], BLOCKS.names)
        release()

    return run


def unpacked(batches, dtype, width, at_least=1):
    """The kept blocks in a task as (matrix, labels, draws), joined to ``at_least`` rows each."""
    held, count = [], 0
    for batch in batches:
        for y, x, draws in zip(*[batch.column(n) for n in BLOCKS.names]):
            y = np.frombuffer(y.as_buffer(), np.uint8)
            x = np.frombuffer(x.as_buffer(), dtype).reshape(len(y), width)
            d = np.frombuffer(draws.as_buffer(), np.uint8).reshape(len(y), -1) if draws.is_valid else None
            held.append((x, y, d))
            count += len(y)
            if count >= at_least:
                yield _joined(held)
                held, count = [], 0
    if held:
        yield _joined(held)


def _joined(parts):
    if len(parts) == 1:
        return parts[0]
    x, y, d = zip(*parts)
    return np.concatenate(x), np.concatenate(y), None if d[0] is None else np.concatenate(d)
