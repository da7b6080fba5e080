"""The two raw CSV inputs: all text on the scan, typed by strict column expressions.

Column pruning is switched off per reader, because the parser only notices a row of the wrong
width when it parses every column.
"""

from pyspark.sql import functions as F, types as T

from riskloom.functions import parsing as P
from riskloom.functions.status import parse_status
from riskloom.schemas import APPLICATION_COLUMNS, APPLICATION_RAW, CREDIT_RAW
from riskloom.sources.records import quoted_records

_CORRUPT = "_corrupt"
_QUOTED = r'"(?:[^"]|"")*"'


def _field_count(line):
    """Fields of a raw CSV line: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.length(bare) - F.length(F.regexp_replace(bare, ",", "")) + 1


def file_order():
    """An orderable struct that restores line order over split files: later lines are greater."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def type_applications(raw):
    """Typed application columns from the 18 text columns; rows without a valid id go.

    Further columns of ``raw`` (a file order, say) are kept.
    """
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in APPLICATION_COLUMNS}
    extra = [c for c in raw.columns if c not in APPLICATION_COLUMNS]
    return raw.select(
        P.parse_number(text["ID"], "bigint").alias("customer_id"),
        text["CODE_GENDER"].alias("gender"),
        P.flag(text["FLAG_OWN_CAR"], "Y").alias("own_car"),
        P.flag(text["FLAG_OWN_REALTY"], "Y").alias("own_realty"),
        P.parse_number(text["CNT_CHILDREN"], "int", 0).alias("children_count"),
        P.parse_number(text["AMT_INCOME_TOTAL"], "double", 0.0).alias("total_income"),
        text["NAME_INCOME_TYPE"].alias("income_type"),
        text["NAME_EDUCATION_TYPE"].alias("education_type"),
        text["NAME_FAMILY_STATUS"].alias("family_status"),
        text["NAME_HOUSING_TYPE"].alias("housing_type"),
        P.parse_number(text["DAYS_BIRTH"], "int", 0).alias("days_birth"),
        P.parse_number(text["DAYS_EMPLOYED"], "int", 0).alias("days_employed"),
        P.flag(text["FLAG_MOBIL"], "1").alias("has_mobile"),
        P.flag(text["FLAG_WORK_PHONE"], "1").alias("has_work_phone"),
        P.flag(text["FLAG_PHONE"], "1").alias("has_phone"),
        P.flag(text["FLAG_EMAIL"], "1").alias("has_email"),
        P.blank_to_null(text["OCCUPATION_TYPE"]).alias("occupation_type"),
        P.parse_number(text["CNT_FAM_MEMBERS"], "double", 1.0).alias("family_members_count"),
        *extra,
    ).where(F.col("customer_id").isNotNull())


def type_credit_records(raw):
    """(customer_id, months_balance, status, status_raw); rows without a valid id or month go."""
    return raw.select(
        P.parse_number(F.col("ID"), "bigint").alias("customer_id"),
        P.parse_number(F.col("MONTHS_BALANCE"), "int").alias("months_balance"),
        parse_status(F.col("STATUS")).alias("status"),
        F.col("STATUS").alias("status_raw"),
    ).where(F.col("customer_id").isNotNull() & F.col("months_balance").isNotNull())


def _raw(spark, path, schema):
    """Text columns of ``schema``, with the line of a row of the wrong width and the file order.

    Files without line breaks inside quotes go to Spark's reader line by line. With such breaks the
    records are put together first, in as many tasks as the files have splits.
    """
    schema = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
    records = quoted_records(spark, path)
    if records is None:
        return (
            spark.read.option("header", True).option("escape", '"').option("columnPruning", False)
            .schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
            .withColumn("file_order", file_order()))
    parsed = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {
        "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return records.select(parsed.alias("r"), F.struct("file", "block", "line").alias("file_order")).select(
        "r.*", "file_order")


def _raw_applications(spark, path):
    return _raw(spark, path, APPLICATION_RAW)


def _wide_enough():
    return F.col(_CORRUPT).isNull() | (_field_count(F.col(_CORRUPT)) >= len(APPLICATION_COLUMNS))


def read_applications(spark, path):
    """Applications with a ``file_order`` column for :func:`dedupe_keep_last`.

    Rows with fewer than 18 fields or without a valid id are left to
    :func:`read_rejected_applications`, surplus fields ignored. Quoted fields may hold line breaks.
    """
    raw = _raw_applications(spark, path)
    return type_applications(raw.where(_wide_enough()).drop(_CORRUPT))


def read_rejected_applications(spark, path):
    """(reason, id, line) of the rows that :func:`read_applications` leaves out; the line is kept
    where its width is wrong."""
    raw = _raw_applications(spark, path)
    reason = F.when(~_wide_enough(), F.lit("fewer than 18 fields")).when(
        P.parse_number(F.coalesce(F.col("ID"), F.lit("")), "bigint").isNull(), F.lit("no valid id"))
    return raw.select(reason.alias("reason"), F.col("ID").alias("id"), F.col(_CORRUPT).alias("line"),
                      *[c for c in APPLICATION_COLUMNS if c != "ID"]).where(
        F.col("reason").isNotNull()).select("reason", "id", "line")


def read_credit_records(spark, path):
    """Bureau records; a row that does not have exactly three fields fails the load."""
    raw = _raw(spark, path, CREDIT_RAW)
    ragged = F.raise_error(F.concat(F.lit("not three fields: "), F.col(_CORRUPT))).cast("string")
    return type_credit_records(raw.withColumn(
        "ID", F.when(F.col(_CORRUPT).isNotNull(), ragged).otherwise(F.col("ID"))))
