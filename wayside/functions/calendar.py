"""Date parts with the conventions the marts use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def sunday_zero(day: Column) -> Column:
    """Day of week, Sunday = 0."""
    return F.dayofweek(day) - 1


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def day_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
