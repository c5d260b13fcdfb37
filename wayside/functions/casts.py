"""Text conversions: lenient ones give NULL, strict ones stop the job.

The strict ones raise by themselves instead of leaning on the session's ANSI
switch, so a load that must fail on bad text fails in every session.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Java reads "1.5d" and "2f" as numbers; feed text like that is not one.
_TYPE_SUFFIX = r"[0-9.][dDfF]\s*$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def conform_double(text: Column | str) -> Column:
    text = _col(text)
    return F.when(~text.rlike(_TYPE_SUFFIX), text.try_cast("double"))


def conform_int(text: Column | str, to: str = "int") -> Column:
    """Whole number from text; '2.5' rounds half away from zero, junk is NULL."""
    text = _col(text)
    return F.coalesce(text.try_cast(to), F.round(conform_double(text)).try_cast(to))


def _or_stop(text: Column, value: Column, what: str) -> Column:
    stop = F.raise_error(F.concat(F.lit(f"not {what}: "), text))
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(stop)


def strict_bigint(text: Column | str) -> Column:
    text = _col(text)
    return _or_stop(text, conform_int(text, "bigint"), "a whole number").cast("bigint")


def strict_timestamp(text: Column | str, pattern: str | None = None) -> Column:
    """Naive local timestamp; empty text is NULL, malformed text stops the job."""
    text = F.nullif(_col(text), F.lit(""))
    if pattern is None:
        value = text.try_cast("timestamp_ntz")
    else:
        value = F.to_timestamp_ntz(text, F.lit(pattern))
    return _or_stop(text, value, "a timestamp").cast("timestamp_ntz")


def clock_seconds(text: Column | str) -> Column:
    """Seconds after the service day's midnight; '25:10:00' is a valid hour."""
    text = _col(text)
    hours, minutes, seconds = (
        strict_bigint(F.split_part(text, F.lit(":"), F.lit(i))) for i in (1, 2, 3)
    )
    return hours * 3600 + minutes * 60 + seconds
