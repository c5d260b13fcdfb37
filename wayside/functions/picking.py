"""One row per key, chosen by an order."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), descending: Collection[str] = ()
) -> DataFrame:
    """First row of each key in the order of `by`; NULLs come last, NULL keys are a group.

    Every other column breaks ties after `by`, so only equal rows tie: the kept
    row never depends on task timing, and a lost executor cannot change a
    published result.

    Catalyst turns the rank filter into a WindowGroupLimit on both sides of the
    exchange: each map task sends at most one row per key, so a key holding a
    third of the input reaches its reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    order = [
        F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in [*by, *rest]
    ]
    ranked = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    return df.withColumn("_pick", F.row_number().over(ranked)).where("_pick = 1").drop("_pick")
