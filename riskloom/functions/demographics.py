"""Columns derived from one application. ``variant``: ``strict`` for models, ``mart`` for reports."""

from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def _years(days, variant):
    years = -days.cast("double") / F.lit(DAYS_PER_YEAR)
    return F.bround(years, 2) if variant == "mart" else years


def age_years(days_birth, variant="strict"):
    return _years(days_birth, variant)


def employment(days_employed, variant="strict"):
    """(years, not-working flag): a positive day count marks people without a job."""
    idle = days_employed > 0
    years = F.when(idle, F.lit(0.0)).otherwise(_years(days_employed, variant))
    return years, F.when(idle, F.lit(1.0)).otherwise(F.lit(0.0))


def family_members(count, variant="strict"):
    """``strict``: positive values stay, the rest is 1. ``mart``: missing is 1, then at least 1."""
    if variant == "mart":
        return F.greatest(F.coalesce(F.when(~F.isnan(count), count), F.lit(1.0)), F.lit(1.0))
    return F.when(~F.isnan(count) & (count > 0), count).otherwise(F.lit(1.0))


def income_per_member(income, family, variant="strict"):
    share = income / family
    return F.bround(share, 2) if variant == "mart" else share


def flag_to_double(col):
    return col.cast("double")
