"""Surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The key text must hash to the same digest everywhere.
SEPARATOR = "||"
NULL_MARK = "_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 of the joined column texts.

    Use on ints, strings, dates and timestamps; doubles print differently per
    engine and would give keys that match nowhere else.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def date_key(day: Column | str) -> Column:
    """20240131 for 2024-01-31; integer arithmetic, no text round trip per row."""
    day = F.col(day) if isinstance(day, str) else day
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
