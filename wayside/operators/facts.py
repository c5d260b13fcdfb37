"""Facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayside.functions.keys import date_key, surrogate_key


def vehicle_position(enriched: DataFrame) -> DataFrame:
    """One row per position report; stored by report_date."""
    return enriched.select(
        "position_sk",
        surrogate_key("mode", "route_id").alias("route_sk"),
        date_key("report_ts").alias("date_key"),
        "agency",
        "mode",
        "route_id",
        "route_name",
        "vehicle_id",
        "lat",
        "lon",
        "heading",
        "is_delayed",
        "report_ts",
        "report_date",
        "report_hour",
    )


def trip_delay(fact_positions: DataFrame) -> DataFrame:
    """The reports flagged as delayed; an unknown flag is not one."""
    return fact_positions.where("is_delayed").drop("heading", "is_delayed")


def congestion(staged: DataFrame) -> DataFrame:
    """One row per road observation; stored by report_date."""
    return staged.select(
        surrogate_key("segment_id", "report_ts").alias("congestion_sk"),
        surrogate_key("segment_id").alias("segment_sk"),
        date_key("report_ts").alias("date_key"),
        "segment_id",
        "report_ts",
        "report_date",
        "report_hour",
        "day_of_week",
        "speed_mph",
        "bus_count",
        "message_count",
        "length_mi",
    )


def weather_daily(staged: DataFrame) -> DataFrame:
    return staged.select(date_key("weather_date").alias("date_key"), "*")
