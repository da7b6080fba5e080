"""Deduplication of applications and per-customer summaries of the monthly bureau history.

Every summary is one ``groupBy`` of conditional counts, so partial sums are formed before the
shuffle and a customer with a third of all months costs one row per map task.
"""

from pyspark.sql import functions as F

from riskloom.functions import status as S
from riskloom.functions.rounding import round_ratio


def dedupe_keep_last(df, key="customer_id", order="file_order"):
    """One row per key: the one with the greatest ``order``. Partial on the map side."""
    payload = [c for c in df.columns if c not in (key, order)]
    return (
        df.groupBy(key).agg(F.max_by(F.struct(*payload), F.col(order)).alias("last"))
        .select(key, "last.*")
    )


def _count_if(condition):
    return F.count(F.when(condition, 1))


def recent_rate(month, late, digits=None):
    """Aggregate: share of late rows among recent ones, 0 without recent rows."""
    recent = S.is_recent(month)
    rows = _count_if(recent)
    share = _count_if(recent & late) / rows if digits is None else round_ratio(
        _count_if(recent & late), rows, digits)
    return F.when(rows > 0, share).otherwise(F.lit(0.0))


def summarize_history(records, variant="strict"):
    """Months (rows) per customer, delinquency counts and rates, default flag.

    ``strict`` gives the 11 model columns; ``mart`` the 8 report columns with rates rounded to 4
    decimals and the raw status text matched exactly.
    """
    month = F.col("months_balance")
    rows = F.count(month)
    if variant == "mart":
        code = F.col("status_raw")
        late, severe = S.is_past_due(code, "mart"), S.is_severe(code)
        return records.groupBy("customer_id").agg(
            rows.alias("total_months_observed"),
            _count_if(late).alias("delinquent_months_count"),
            _count_if(severe).alias("severe_delinquency_count"),
            round_ratio(_count_if(late), rows).alias("historical_delinquency_rate"),
            F.max(S.severity(code, "mart")).alias("max_past_due_severity"),
            recent_rate(month, late, 4).alias("delinquency_rate_last_6m"),
            F.when(_count_if(severe) > 0, 1).otherwise(0).alias("is_default"),
        )
    code = F.col("status")
    late, severe = S.is_past_due(code), S.is_severe(code)
    return records.groupBy("customer_id").agg(
        rows.alias("total_months_observed"),
        F.least(F.lit(0), F.min(month)).alias("min_month_balance"),
        F.max(month).alias("max_month_balance"),
        _count_if(severe).alias("severe_delinquency_count"),
        _count_if(late).alias("any_delinquency_count"),
        (_count_if(severe) > 0).alias("is_bad_customer"),
        (_count_if(late) / rows).alias("delinquency_rate"),
        F.max(S.severity(code)).cast("double").alias("max_severity"),
        recent_rate(month, late).alias("recent_delinquency_rate_6m"),
        (-F.max(F.when(late, month))).alias("months_since_last_delinquency"),
    )
