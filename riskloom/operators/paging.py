"""Customer lookup, id search and pages in id order."""

import re

from pyspark.sql import functions as F

from riskloom.operators import ranking as R

DEFAULT_LIMIT, MAX_LIMIT = 20, 100
_SHALLOW = 10_000
_I64 = (-(2**63), 2**63 - 1)


def search_text_to_id(text):
    """The integer a search text stands for, or None: blanks around it and leading zeros go."""
    body = (text or "").strip()
    if not re.fullmatch(r"[+-]?[0-9]+", body):
        return None
    number = int(body)
    return number if _I64[0] <= number <= _I64[1] else None


def search_customers(df, text, key="customer_id"):
    """Customers whose id contains the digits; text that is no integer filters nothing."""
    number = search_text_to_id(text)
    return df if number is None else df.where(F.col(key).cast("string").contains(str(number)))


def get_customer(df, customer_id, key="customer_id"):
    return df.where(F.col(key) == F.lit(customer_id))


def page_bounds(page=None, limit=None):
    """(page, limit) with defaults and bounds applied."""
    page = max(1, 1 if page is None else page)
    return page, min(MAX_LIMIT, max(1, DEFAULT_LIMIT if limit is None else limit))


def page_of(df, page=None, limit=None, key="customer_id"):
    """The rows of one page, 100 at most.

    Only the id column takes part in finding the page. Its ids then filter the scan; what the
    caller computes on the rows cannot slip below the limit and run for the whole table.
    """
    page, limit = page_bounds(page, limit)
    ids = [r[0] for r in list_recent(df.select(key), limit, (page - 1) * limit, key).collect()]
    return df.where(F.col(key).isin(ids))


def list_recent(df, limit, offset=0, key="customer_id", rows_per_bucket=R.ROWS_PER_BUCKET):
    """``limit`` rows in id order after ``offset``.

    A page near the start is a bounded top-n. A deep one first counts rows between id quantiles
    and sorts only the slice that holds it, so no task ever takes all the rows before a page.
    """
    if offset + limit > _SHALLOW:
        _, cuts = R.cut_points(df, key, rows_per_bucket)
        cuts = sorted(set(cuts))
        if cuts:
            counts = dict(
                df.groupBy(R.bucket_of(F.col(key), cuts).alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n")).collect())
            df, offset = _slice(df, key, cuts, counts, offset, limit)
    return df.orderBy(key).offset(offset).limit(limit)


def _slice(df, key, cuts, counts, offset, limit):
    """The part of ``df`` between two cuts that covers the rows, and the offset inside it."""
    first, before = 0, 0
    while first < len(cuts) and before + counts.get(first, 0) <= offset:
        before += counts.get(first, 0)
        first += 1
    last, covered = first, before + counts.get(first, 0)
    while last < len(cuts) and covered < offset + limit:
        last += 1
        covered += counts.get(last, 0)
    if first > 0:
        df = df.where(F.col(key) > F.lit(cuts[first - 1]))
    if last < len(cuts):
        df = df.where(F.col(key) <= F.lit(cuts[last]))
    return df, offset - before


def total_count(df):
    return df.agg(F.count(F.lit(1)).alias("total"))
