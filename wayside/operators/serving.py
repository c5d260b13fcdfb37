"""The reports read by people: small projections and top-k lists over marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayside.functions.boxes import is_finite
from wayside.functions.picking import keep_first

# Reports needed before a route is listed, list lengths, live window.
MIN_REPORTS = 20
WORST_ROUTES = 20
HOTSPOTS = 30
EXPORTED_HOTSPOTS = 200
LIVE_MINUTES = 5


def worst_otp(otp: DataFrame, top: int = WORST_ROUTES, at_least: int = MIN_REPORTS) -> DataFrame:
    """Routes with the worst record among those reported often enough."""
    order = [F.col(c).asc_nulls_last() for c in ("on_time_rate", "mode", "route_id", "route_name")]
    rows = otp.where(F.col("total_reports") >= at_least).orderBy(*order).limit(top)
    return rows.select("route_id", "route_name", "mode", "total_reports", "on_time_rate")


def otp_by_hour(mode_hours: DataFrame) -> DataFrame:
    return mode_hours.select("mode", "report_hour", "on_time_rate").orderBy(
        F.col("report_hour").asc_nulls_last(), F.col("mode").asc_nulls_last()
    )


def hotspots(ranked: DataFrame, top: int = HOTSPOTS) -> DataFrame:
    return ranked.orderBy("congestion_rank", F.col("segment_id").asc_nulls_last()).limit(top)


def speed_by_hour(road_hours: DataFrame) -> DataFrame:
    return road_hours.select(
        F.col("report_hour").cast("int").alias("report_hour"),
        F.col("avg_speed_mph").cast("double").alias("avg_speed_mph"),
    ).orderBy(F.col("report_hour").asc_nulls_last())


def delay_weather_points(delay_weather: DataFrame) -> DataFrame:
    points = delay_weather.select("report_date", "mode", "delayed_rate", "precip_mm", "snow_cm", "temp_avg_c")
    return points.dropna(subset=["delayed_rate", "precip_mm", "temp_avg_c"]).orderBy("report_date", "mode")


def delay_congestion_points(delay_congestion: DataFrame) -> DataFrame:
    return delay_congestion.select("report_hour", "delayed_rate", "road_avg_speed_mph").orderBy(
        F.col("report_hour").asc_nulls_last()
    )


def recent_fleet(positions: DataFrame, minutes: int = LIVE_MINUTES) -> DataFrame:
    """Reports of the last minutes before the table's own newest report.

    The newest time is a scalar subquery over one column. Comparing the date as
    well lets a table stored by report_date prune all older days.
    """
    newest = positions.agg(F.max("report_ts")).scalar()
    since = newest - F.expr(f"interval {int(minutes)} minutes")
    recent = positions.where((F.col("report_date") >= F.to_date(since)) & (F.col("report_ts") >= since))
    return recent.select("mode", "route_id", "lat", "lon", "is_delayed")


def fleet_latest(positions: DataFrame) -> DataFrame:
    """Newest report of every vehicle."""
    columns = ["agency", "mode", "route_id", "route_name", "lat", "lon", "heading", "is_delayed", "report_ts"]
    reports = positions.select("vehicle_id", *columns)
    newest = keep_first(reports, ["mode", "vehicle_id"], by=["report_ts"], descending=["report_ts"])
    return newest.select(*columns)


def headline(freshness: DataFrame) -> DataFrame:
    """The four headline figures in one row."""

    def of(source: str, column: str):
        return F.max(F.when(F.col("source") == source, F.col(column)))

    return freshness.agg(
        of("vehicle_positions", "row_count").alias("vehicle_position_rows"),
        of("congestion", "row_count").alias("congestion_rows"),
        of("weather", "row_count").alias("weather_days"),
        of("vehicle_positions", "latest_ts").alias("latest_position"),
    )


def map_points(rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows that can be drawn on a map."""
    return rows.where(is_finite(lat) & is_finite(lon))
