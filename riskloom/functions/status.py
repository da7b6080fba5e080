"""Monthly bureau status codes."""

from pyspark.sql import functions as F

from riskloom.functions.parsing import strip

# Status codes and their severity.
STATUS_CODES = ["C", "X", "0", "1", "2", "3", "4", "5"]
UNKNOWN_STATUS = "0"
SEVERITY = {"C": 0, "X": 0, "0": 1, "1": 2, "2": 3, "3": 4, "4": 5, "5": 6}
SEVERE_CODES = ["2", "3", "4", "5"]
PAST_DUE_CODES = ["0", "1", "2", "3", "4", "5"]
RECENT_MONTHS = 6


def parse_status(col):
    """Trimmed code; anything unknown (or missing) counts as 1-29 days late."""
    code = strip(col)
    return F.when(code.isin(STATUS_CODES), code).otherwise(F.lit(UNKNOWN_STATUS))


def severity(col, variant="strict"):
    """0 for paid or no loan, 1..6 for growing delay.

    ``strict`` expects a code from :func:`parse_status`. ``mart`` takes the raw text: C and X
    are 0, any integer text is its value plus one, everything else is 0.
    """
    if variant == "mart":
        digits = strip(col)
        number = F.when(digits.rlike(r"^[+-]?[0-9]+\z"), digits.try_cast("int"))
        return F.when(col.isin("C", "X"), 0).otherwise(F.coalesce(number + 1, F.lit(0)))
    result = F.when(col.isin("C", "X"), 0)
    for code in PAST_DUE_CODES:
        result = result.when(col == code, SEVERITY[code])
    return result.otherwise(SEVERITY[UNKNOWN_STATUS])


def is_severe(col):
    """60 days late or more."""
    return F.coalesce(col.isin(SEVERE_CODES), F.lit(False))


def is_past_due(col, variant="strict"):
    """At least one day late. ``mart`` matches the raw text exactly."""
    if variant == "mart":
        return F.coalesce(col.isin(PAST_DUE_CODES), F.lit(False))
    return severity(col) >= 1


def is_recent(month, window=RECENT_MONTHS):
    """Within the last ``window`` months; months in the future count too."""
    return month >= -(window - 1)
