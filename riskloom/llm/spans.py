"""Columns over arrays of found spans, structs with ``kind``, ``start`` and ``end``."""

from pyspark.sql import functions as F


def of_kinds(spans, kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_kind(spans, kind):
    return F.size(of_kinds(spans, [kind])).cast("long")


def as_text(spans):
    """``kind:start:end``, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
