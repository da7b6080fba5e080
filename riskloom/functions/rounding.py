"""Rounding as a language with binary floats does it: by the exact value of the double."""

from pyspark.sql import functions as F


def _quotient(a, b):
    """Whole part of a / b for nonnegative longs."""
    return ((a - a % b) / b).cast("bigint")


def round_ratio(part, whole, digits=4):
    """``part / whole`` of nonnegative whole numbers, rounded half to even on the quotient's double.

    Away from ties whole numbers decide. At a tie the double may lie beside it: the remainder
    ``part - double * whole`` tells the side. It is exact, because the double is taken in two
    halves whose products with ``whole`` have no rounding error (for ``whole`` below 2 ** 26).
    """
    scale = 10**digits
    k, n = part.cast("bigint"), whole.cast("bigint")
    twice = k * F.lit(2 * scale)
    up = _quotient(twice + n, n * 2)
    tie = (twice % n == 0) & (_quotient(twice, n) % 2 == 1)
    quotient, divisor = k / n, n.cast("double")
    spread = quotient * F.lit(134217729.0)  # 2 ** 27 + 1 cuts a double in two
    high = spread - (spread - quotient)
    rest = (k.cast("double") - high * divisor) - (quotient - high) * divisor
    at_tie = F.when(rest < 0, up).when(rest > 0, up - 1).otherwise(up - up % 2)
    return F.when(tie, at_tie).otherwise(up) / F.lit(float(scale))
