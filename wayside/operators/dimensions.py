"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayside.functions.calendar import day_name, day_spine, month_name, sunday_zero
from wayside.functions.keys import date_key, surrogate_key
from wayside.operators.silver import AGENCY

# The calendar's range and the constant dimension rows.
FIRST_DAY, LAST_DAY = "2018-01-01", "2026-12-31"
AGENCY_ROWS = [(AGENCY, "Chicago Transit Authority", "Chicago, IL", True)]
MODE_ROWS = [
    ("bus", "Bus", "CTA bus fleet (BusTime)"),
    ("train", "Rail", 'CTA "L" rail lines (Train Tracker)'),
]
FEED_ROUTE_TYPES = {"bus": "bus", "train": "subway"}


def dates(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    day = F.col("date_day")
    weekday = sunday_zero(day)
    return day_spine(spark, first, last).select(
        day,
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        day_name(day).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def agencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        AGENCY_ROWS, "agency string, agency_name string, locale string, is_active boolean"
    )


def modes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODE_ROWS, "mode string, mode_name string, description string")


def routes(static: DataFrame, positions: DataFrame) -> DataFrame:
    """Timetable bus routes plus every (mode, route) the feeds mention beyond them.

    The reports shrink to their distinct pairs before the anti join. The mode in
    the join key keeps every rail route, also one named like a bus route.
    """
    listed = static.select(
        F.lit("bus").alias("mode"),
        "route_id",
        F.col("route_long_name").alias("route_name"),
        "route_short_name",
        "route_type_name",
        "route_color",
    )
    seen = positions.select("mode", "route_id").distinct()
    no_text = F.lit(None).cast("string")
    unlisted = seen.join(listed, ["mode", "route_id"], "left_anti").select(
        "mode",
        "route_id",
        F.col("route_id").alias("route_name"),
        no_text.alias("route_short_name"),
        F.when(F.col("mode") == "train", FEED_ROUTE_TYPES["train"])
        .otherwise(FEED_ROUTE_TYPES["bus"])
        .alias("route_type_name"),
        no_text.alias("route_color"),
    )
    return (
        listed.unionByName(unlisted)
        .distinct()
        .select(surrogate_key("mode", "route_id").alias("route_sk"), F.lit(AGENCY).alias("agency"), "*")
    )


def stops(staged: DataFrame) -> DataFrame:
    return staged.select(surrogate_key("agency", "stop_id").alias("stop_sk"), "*")


LABELS = ["street", "direction", "from_street", "to_street"]
SIZES = ["length_mi", "start_lat", "start_lon", "end_lat", "end_lon"]


def segments(congestion: DataFrame) -> DataFrame:
    """One row per road segment: some label of each kind, averaged measures.

    Of several labels the smallest is taken, so reruns agree. Grouping by the
    labels first keeps the large pass a hash aggregate; min() over text straight
    from the observations would make Spark sort them all.
    """
    parts = congestion.groupBy("segment_id", *LABELS).agg(
        *(F.sum(c).alias(f"_{c}_sum") for c in SIZES),
        *(F.count(c).alias(f"_{c}_n") for c in SIZES),
    )
    means = [
        (F.sum(f"_{c}_sum") / F.nullif(F.sum(f"_{c}_n"), F.lit(0).cast("bigint"))).alias(c) for c in SIZES
    ]
    merged = parts.groupBy("segment_id").agg(*(F.min(c).alias(c) for c in LABELS), *means)
    return merged.select("segment_id", surrogate_key("segment_id").alias("segment_sk"), *LABELS, *SIZES)
