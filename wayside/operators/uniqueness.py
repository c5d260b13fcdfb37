"""Repeated keys in two steps: fingerprints first, and full keys only where one repeats.

A key of texts or of several columns is reduced to 64 bits before the shuffle, and equal
fingerprints are counted. Where none repeats no key does, and that is all. Otherwise a
bitmap of fixed size says which rows may share a fingerprint; only their keys cross a
shuffle, and an exact count of them decides. Chance collisions cost a few rows, never a
wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

#: Bits of the bitmap: at most 262,144 words of 64, whatever the table.
BITS = 1 << 24


def wide(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a fingerprint is smaller than the key."""
    return len(keys) > 1 or isinstance(df.schema[keys[0]].dataType, StringType)


def repeated_keys(df: DataFrame, keys: Sequence[str], mark: Callable[..., Column] = F.xxhash64) -> tuple[int, int]:
    """(keys that occur more than once, rows); NULLs are a key like any other."""
    marks = df.groupBy(mark(*keys).alias("mark")).agg(F.count(F.lit(1)).alias("n"))
    seen = marks.agg(F.count_if(F.col("n") > 1).alias("shared"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if not seen["shared"]:
        return 0, seen["rows"]
    exact = suspects(df, keys, marks.where("n > 1"), mark).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return exact.where("_copies > 1").count(), seen["rows"]


def suspects(df: DataFrame, keys: Sequence[str], marks: DataFrame, mark: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """The keys of the rows whose fingerprint may be among `marks`; none is missing."""
    bit = F.pmod("mark", F.lit(BITS)).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)
    words = marks.groupBy(F.expr(f"cast(pmod(mark, {BITS}) div 64 as int)").alias("word")).agg(F.bit_or(set_bit).alias("bits"))
    rows = df.select(*keys, mark(*keys).alias("mark"))
    rows = rows.withColumns({"word": F.expr(f"cast(pmod(mark, {BITS}) div 64 as int)"), "bit": bit % 64})
    # The words are bounded by BITS, so this side is broadcast whatever the table.
    return rows.join(F.broadcast(words), "word").where(F.expr("(shiftrightunsigned(bits, bit) & 1) = 1")).select(*keys)
