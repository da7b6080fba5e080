"""Strict text parsing: what does not parse becomes the stated default, never an error."""

from pyspark.sql import functions as F

# The accepted number spellings (no surrounding blanks, no type suffix).
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
FLOAT_PATTERN = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)\z"

_EDGE_BLANKS = r"(?U)^\s+|\s+\z"


def strip(col):
    """Remove every kind of whitespace at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(col, _EDGE_BLANKS, "")


def parse_number(col, dtype, default=None):
    """``col`` as ``dtype`` (int, bigint or double); text that is not such a number is ``default``."""
    if dtype == "double":
        # A sign before nan is legal text but no Spark literal.
        is_nan = F.lower(col).isin("nan", "+nan", "-nan")
        value = F.when(is_nan, F.lit(float("nan"))).when(col.rlike(FLOAT_PATTERN), col.try_cast(dtype))
    else:
        value = F.when(col.rlike(INTEGER_PATTERN), col.try_cast(dtype))
    return value if default is None else F.coalesce(value, F.lit(default).cast(dtype))


def flag(col, truth):
    """Exact, untrimmed match; NULL is false."""
    return col.eqNullSafe(F.lit(truth))


def blank_to_null(col):
    """NULL if only whitespace, the untouched text otherwise."""
    return F.when(strip(col) != "", col)
