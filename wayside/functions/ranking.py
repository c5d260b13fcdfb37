"""rank() over a whole table without sending the table to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wayside.storage import settle


def global_rank(df: DataFrame, by: str, name: str) -> DataFrame:
    """Add rank() over (order by `by` nulls last) as a bigint column.

    Only distinct values are sorted, each carrying its row count, so a value
    shared by a third of the rows costs one row. The sort leaves consecutive
    value ranges in consecutive tasks; a running sum inside each range plus the
    totals of the ranges before it gives the rank. The single-task step sees one
    row per sort task, never the data.
    """
    rows = settle(df, "rank-rows")
    tally = (
        rows.groupBy(by)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.col(by).asc_nulls_last())
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    tally = settle(tally, "rank-values").withColumn("_range", F.shiftright("_slot", 33))

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = tally.groupBy("_range").agg(F.sum("_n").alias("_total"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))

    inside = Window.partitionBy("_range").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        tally.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(ranges, "_range")
        .select(F.col(by).alias("_value"), (F.col("_before") + F.col("_inside") + 1).alias(name))
    )
    return rows.join(ranks, rows[by].eqNullSafe(ranks["_value"])).drop("_value")
