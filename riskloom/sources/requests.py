"""Score requests: JSON lines with three optional fields."""

from pyspark.sql import functions as F, types as T

from riskloom.functions.demographics import family_members
from riskloom.schemas import FEATURES, OPTIONAL_REQUEST_FIELDS, SCORE_REQUEST

DEFAULT_CUSTOMER_ID = 9999999


_CORRUPT = "_corrupt"
_REASON = "reason"


def raw_requests(reader, path, multiline=False):
    """Requests as they are, with the text of those that are no JSON object in ``_corrupt``.

    ``reader`` is ``spark.read`` or ``spark.readStream``; ``multiline`` takes each file as one
    object or array, otherwise each line is a request.
    """
    schema = T.StructType(SCORE_REQUEST.fields + [T.StructField(_CORRUPT, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).option(
        "multiLine", multiline).json(path)


def with_reason(df):
    """Adds ``reason``, null for a request that can be scored: what is malformed or missing."""
    missing = F.array_join(F.array_compact(F.array(*[
        F.when(F.col(f).isNull(), F.lit(f)) for f in FEATURES if f not in OPTIONAL_REQUEST_FIELDS])), ", ")
    corrupt = F.col(_CORRUPT).isNotNull() if _CORRUPT in df.columns else F.lit(False)
    return df.withColumn(_REASON, F.when(corrupt, F.lit("malformed")).when(
        missing != "", F.concat(F.lit("missing: "), missing)))


def complete_requests(df, on_reject="fail"):
    """Requests with all 13 required numbers. Others fail the job with their reason, as the service
    fails the call; ``on_reject="skip"`` leaves them to :func:`rejected`."""
    checked = with_reason(df)
    if on_reject == "fail":
        # The error hangs on a column that every request needs, so that no plan leaves it out.
        guard = FEATURES[0]
        checked = checked.withColumn(guard, F.when(F.col(_REASON).isNull(), F.col(guard)).otherwise(
            F.raise_error(F.concat(F.lit("rejected request: "), F.col(_REASON))).cast("double")))
    elif on_reject == "skip":
        checked = checked.where(F.col(_REASON).isNull())
    else:
        raise ValueError(f"on_reject is fail or skip, not {on_reject}")
    return checked.drop(_CORRUPT, _REASON)


def rejected(df):
    """The requests that cannot be scored, with their reason."""
    return with_reason(df).where(F.col(_REASON).isNotNull())


def read_score_requests(spark, path, on_reject="fail", multiline=False):
    """Requests to score; see :func:`complete_requests` for what becomes of the others."""
    return complete_requests(raw_requests(spark.read, path, multiline), on_reject)


def read_rejected_requests(spark, path, multiline=False):
    """What ``on_reject="skip"`` leaves out of the same files, with the reason."""
    # Spark wants other columns than the corrupt one from such a scan.
    return rejected(raw_requests(spark.read, path, multiline))


def normalize_requests(df):
    """Fill the optional fields and guard the family size."""
    family = family_members(F.col("family_members_count"))
    filled = {
        "is_unemployed_or_retired": F.coalesce(
            F.col("is_unemployed_or_retired"),
            F.when(F.col("employment_years") <= 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        ),
        "income_per_family_member": F.coalesce(
            F.col("income_per_family_member"), F.col("annual_income") / family
        ),
        "family_members_count": family,
    }
    return df.select(
        F.coalesce(F.col("customer_id"), F.lit(DEFAULT_CUSTOMER_ID)).alias("customer_id"),
        *[filled.get(f, F.col(f)).alias(f) for f in FEATURES],
    )
