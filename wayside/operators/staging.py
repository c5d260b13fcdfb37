"""Staging: light reshaping of the conformed tables, no shuffle anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayside.functions.keys import surrogate_key

# Timetable route types.
ROUTE_TYPES = {0: "tram", 1: "subway", 2: "rail", 3: "bus"}
OTHER_TYPE = "other"


def routes(silver: DataFrame) -> DataFrame:
    named = F.lit(OTHER_TYPE)
    for code, name in ROUTE_TYPES.items():
        named = F.when(F.col("route_type") == code, name).otherwise(named)
    return silver.select(
        "agency",
        "route_id",
        "route_short_name",
        "route_long_name",
        "route_type",
        named.alias("route_type_name"),
        "route_color",
        "route_text_color",
    )


def stops(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull())


def trips(silver: DataFrame) -> DataFrame:
    return silver.select(
        "agency",
        "trip_id",
        "route_id",
        "service_id",
        "direction_id",
        "direction_name",
        "block_id",
        "shape_id",
        "schd_trip_id",
        "wheelchair_accessible",
    )


def stop_times(silver: DataFrame) -> DataFrame:
    """Adds the hour of day the stop is due at, also for times past midnight."""
    return silver.withColumn("scheduled_hour", F.expr("(arrival_sec div 3600) % 24"))


def vehicle_positions(silver: DataFrame) -> DataFrame:
    placed = silver.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return placed.select(
        surrogate_key("mode", "vehicle_id", "report_ts").alias("position_sk"),
        "agency",
        "mode",
        "vehicle_id",
        "route_id",
        "headsign",
        "lat",
        "lon",
        "heading",
        "is_delayed",
        "report_ts",
        F.to_date("report_ts").alias("report_date"),
        F.hour("report_ts").alias("report_hour"),
        "_ingested_at",
    )


def congestion(silver: DataFrame) -> DataFrame:
    """The hour is the feed's own, not taken from the timestamp."""
    day = F.to_date("report_ts").alias("report_date")
    return silver.withColumnRenamed("hour", "report_hour").select("*", day)


def weather(silver: DataFrame) -> DataFrame:
    return silver.select(
        "*",
        ((F.col("temp_max_c") + F.col("temp_min_c")) / F.lit(2.0)).alias("temp_avg_c"),
        (F.col("precip_mm") > 0).alias("is_wet_day"),
        (F.col("snow_cm") > 0).alias("is_snow_day"),
    )
