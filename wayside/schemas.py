"""Declared schemas of landed and conformed tables; nothing is inferred.

Fixed values: column names and types are the tables' public contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BRONZE = {
    "bus_positions": (
        "vid string, tmstmp timestamp_ntz, lat double, lon double, hdg int, pid bigint, rt string, "
        "des string, pdist bigint, dly boolean, tatripid string, origtatripno string, "
        "tablockid string, zone string, _ingested_at timestamp_ntz"
    ),
    "train_positions": (
        "rn string, rt string, tmstmp timestamp_ntz, lat double, lon double, heading int, "
        "destNm string, destSt string, nextStaId string, nextStaNm string, nextStpId string, "
        "arrT timestamp_ntz, isApp boolean, isDly boolean, trDr string, _ingested_at timestamp_ntz"
    ),
    "decoded_trains": (
        "vehicle_id string, route_id string, lat double, lon double, heading int, "
        "is_delayed boolean, stop_id string, report_ts timestamp_ntz"
    ),
    "congestion": (
        "segment_id string, time string, speed string, street string, direction string, "
        "from_street string, to_street string, length string, bus_count string, "
        "message_count string, hour string, day_of_week string, month string, "
        "start_latitude string, start_longitude string, end_latitude string, end_longitude string"
    ),
}

SILVER = {
    "silver_routes": (
        "agency string, route_id string, route_short_name string, route_long_name string, "
        "route_type int, route_color string, route_text_color string"
    ),
    "silver_stops": (
        "agency string, stop_id string, stop_code string, stop_name string, stop_lat double, "
        "stop_lon double, location_type int, parent_station string, wheelchair_boarding int"
    ),
    "silver_trips": (
        "agency string, route_id string, service_id string, trip_id string, direction_name string, "
        "direction_id int, block_id string, shape_id string, schd_trip_id string, "
        "wheelchair_accessible int"
    ),
    "silver_stop_times": (
        "agency string, trip_id string, stop_id string, arrival_time string, departure_time string, "
        "arrival_sec bigint, stop_sequence int, stop_headsign string, pickup_type string, "
        "shape_dist_traveled double"
    ),
    "silver_vehicle_positions": (
        "agency string, mode string, vehicle_id string, route_id string, headsign string, lat double, "
        "lon double, heading int, is_delayed boolean, report_ts timestamp_ntz, _ingested_at timestamp_ntz"
    ),
    "silver_congestion": (
        "segment_id int, report_ts timestamp_ntz, speed_mph int, street string, direction string, "
        "from_street string, to_street string, length_mi double, bus_count int, message_count int, "
        "hour int, day_of_week int, month int, start_lat double, start_lon double, end_lat double, "
        "end_lon double"
    ),
    "silver_weather": (
        "weather_date date, temp_max_c double, temp_min_c double, precip_mm double, rain_mm double, "
        "snow_cm double, wind_kmh double, gust_kmh double"
    ),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty_silver(spark: SparkSession) -> dict[str, DataFrame]:
    """Every conformed table with no rows, to dry-run the models and checks."""
    return {name: spark.createDataFrame([], struct(ddl)) for name, ddl in SILVER.items()}
