"""Conformed tables: typed, renamed, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayside.functions.boxes import in_box
from wayside.functions.casts import clock_seconds, conform_double, conform_int, strict_timestamp
from wayside.functions.picking import keep_first

# Fixed value: every conformed row belongs to this agency.
AGENCY = "CTA"


def _agency() -> Column:
    return F.lit(AGENCY).alias("agency")


def routes(raw: DataFrame) -> DataFrame:
    return raw.select(
        _agency(),
        "route_id",
        "route_short_name",
        "route_long_name",
        conform_int("route_type").alias("route_type"),
        "route_color",
        "route_text_color",
    )


def stops(raw: DataFrame) -> DataFrame:
    return raw.select(
        _agency(),
        "stop_id",
        "stop_code",
        "stop_name",
        conform_double("stop_lat").alias("stop_lat"),
        conform_double("stop_lon").alias("stop_lon"),
        conform_int("location_type").alias("location_type"),
        "parent_station",
        conform_int("wheelchair_boarding").alias("wheelchair_boarding"),
    )


def trips(raw: DataFrame) -> DataFrame:
    return raw.select(
        _agency(),
        "route_id",
        "service_id",
        "trip_id",
        F.col("direction").alias("direction_name"),
        conform_int("direction_id").alias("direction_id"),
        "block_id",
        "shape_id",
        "schd_trip_id",
        conform_int("wheelchair_accessible").alias("wheelchair_accessible"),
    )


def stop_times(raw: DataFrame) -> DataFrame:
    """Arrival as seconds of the service day; an unreadable time stops the job."""
    return raw.select(
        _agency(),
        "trip_id",
        "stop_id",
        "arrival_time",
        "departure_time",
        clock_seconds("arrival_time").alias("arrival_sec"),
        conform_int("stop_sequence").alias("stop_sequence"),
        "stop_headsign",
        "pickup_type",
        conform_double("shape_dist_traveled").alias("shape_dist_traveled"),
    )


def train_positions(decoded: DataFrame) -> DataFrame:
    """One decoded report per train and report time."""
    return keep_first(decoded, ["vehicle_id", "report_ts"])


def bus_reports(raw: DataFrame) -> DataFrame:
    return raw.select(
        _agency(),
        F.lit("bus").alias("mode"),
        F.col("vid").alias("vehicle_id"),
        F.col("rt").alias("route_id"),
        F.col("des").alias("headsign"),
        "lat",
        "lon",
        F.col("hdg").alias("heading"),
        F.col("dly").alias("is_delayed"),
        F.col("tmstmp").alias("report_ts"),
        "_ingested_at",
    )


def train_reports(trains: DataFrame) -> DataFrame:
    return trains.select(
        _agency(),
        F.lit("train").alias("mode"),
        "vehicle_id",
        "route_id",
        F.lit(None).cast("string").alias("headsign"),
        "lat",
        "lon",
        "heading",
        "is_delayed",
        "report_ts",
        F.col("report_ts").alias("_ingested_at"),
    )


def earliest_reports(reports: DataFrame) -> DataFrame:
    """In-town reports, the first ingested one per vehicle and report time."""
    in_town = reports.where(in_box("lat", "lon"))
    return keep_first(in_town, ["mode", "vehicle_id", "report_ts"], by=["_ingested_at"])


def vehicle_positions(bus: DataFrame, trains: DataFrame, trains_unique: bool = False) -> DataFrame:
    """Bus and rail reports in one schema, deduplicated.

    Keys never cross modes, so trains that `train_positions` has already made
    unique skip the second exchange: pass `trains_unique=True` for those.
    """
    rail = train_reports(trains)
    if trains_unique:
        return earliest_reports(bus_reports(bus)).unionByName(rail.where(in_box("lat", "lon")))
    return earliest_reports(bus_reports(bus).unionByName(rail))


def congestion(raw: DataFrame) -> DataFrame:
    """Road observations with a usable speed, the first ingested one per raw key.

    The key is the text as it arrived: segments '1' and '01' stay apart even
    though both become 1.
    """
    usable = raw.where(conform_int("speed") >= 0)
    first = keep_first(usable, ["segment_id", "time"], by=["_ingested_at"])
    return first.select(
        conform_int("segment_id").alias("segment_id"),
        strict_timestamp("time").alias("report_ts"),
        conform_int("speed").alias("speed_mph"),
        "street",
        "direction",
        "from_street",
        "to_street",
        conform_double("length").alias("length_mi"),
        *(conform_int(c).alias(c) for c in ("bus_count", "message_count", "hour", "day_of_week", "month")),
        conform_double("start_latitude").alias("start_lat"),
        conform_double("start_longitude").alias("start_lon"),
        conform_double("end_latitude").alias("end_lat"),
        conform_double("end_longitude").alias("end_lon"),
    )


def weather(raw: DataFrame) -> DataFrame:
    """One row per day, from the last load that has the day."""
    last = keep_first(raw, ["date"], by=["_ingested_at"], descending=["_ingested_at"])
    return last.select(
        F.col("date").cast("date").alias("weather_date"),
        F.col("temperature_2m_max").alias("temp_max_c"),
        F.col("temperature_2m_min").alias("temp_min_c"),
        F.col("precipitation_sum").alias("precip_mm"),
        F.col("rain_sum").alias("rain_mm"),
        F.col("snowfall_sum").alias("snow_cm"),
        F.col("wind_speed_10m_max").alias("wind_kmh"),
        F.col("wind_gusts_10m_max").alias("gust_kmh"),
    )
