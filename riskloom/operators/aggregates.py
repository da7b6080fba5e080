"""Portfolio-wide statistics: each is one partial-then-final aggregate over the rows."""

from pyspark.sql import functions as F

from riskloom.schemas import FEATURES, LABEL

MIN_DEVIATION = 1e-7
VARIANCE_SMOOTHING = 1e-6


def target_stats(df, label=LABEL):
    bad = F.count(F.when(F.col(label) == 1, 1))
    return df.agg(
        bad.alias("bad_count"),
        F.count(F.lit(1)).alias("total_count"),
        (F.try_divide(bad, F.count(F.lit(1))) * 100).alias("default_rate_pct"),
    )


def feature_means(df, names=FEATURES):
    return df.agg(*[F.avg(n).alias(n) for n in names])


def feature_moments(df, names=FEATURES):
    """One row: ``mean_<f>`` and ``sd_<f>`` (population; near-constant features get 1)."""
    columns = []
    for n in names:
        sd = F.stddev_pop(n)
        columns.append(F.avg(n).alias(f"mean_{n}"))
        columns.append(F.when(sd < MIN_DEVIATION, F.lit(1.0)).otherwise(sd).alias(f"sd_{n}"))
    return df.agg(*columns)


def class_moments(df, names=FEATURES, label=LABEL, smoothing=VARIANCE_SMOOTHING):
    """Per class (1, and 0 for everything else): rows, ``mean_<f>``, smoothed ``var_<f>``."""
    columns = [F.count(F.lit(1)).alias("samples")]
    for n in names:
        columns.append(F.avg(n).alias(f"mean_{n}"))
        columns.append((F.var_pop(n) + F.lit(smoothing)).alias(f"var_{n}"))
    return df.groupBy(_class_of(label).alias("class")).agg(*columns)


def _class_of(label):
    return F.when(F.col(label) == 1, 1).otherwise(0)


def class_weights(df, label=LABEL):
    """One row: rows, both class counts (at least 1) and the balancing weights n / (2 count)."""
    n = F.count(F.lit(1))
    pos = F.greatest(F.count(F.when(F.col(label) == 1, 1)), F.lit(1))
    neg = F.greatest(n - pos, F.lit(1))
    return df.agg(
        n.alias("samples"), pos.alias("n_pos"), neg.alias("n_neg"),
        (n / (F.lit(2.0) * pos)).alias("w_pos"), (n / (F.lit(2.0) * neg)).alias("w_neg"),
    )


def service_summary(df, model_name):
    return df.agg(F.count(F.lit(1)).alias("total_customers")).select(
        F.lit("ok").alias("status"), "total_customers", F.lit(model_name).alias("active_model")
    )
