"""Conformed tables, staging, aggregates, star schema and marts."""

from __future__ import annotations

from registry import query
from registry.inputs import model, rounded
from registry.parts import whole


def _register(name: str, table: str, part: str, *doubles: str) -> None:
    """`doubles` are the averages and shares, which are compared rounded."""
    query(name, whole(part, *doubles))(lambda spark, sf_dir: rounded(model(spark, sf_dir, table), *doubles))


_register("slv_01_routes", "silver_routes", "x_silver_routes")
_register("slv_02_stops", "silver_stops", "x_silver_stops")
_register("slv_03_trips", "silver_trips", "x_silver_trips")
_register("slv_04_stop_times", "silver_stop_times", "x_silver_stop_times")
_register("slv_05_train_positions", "silver_train_positions", "x_silver_trains")
_register("slv_06_vehicle_positions", "silver_vehicle_positions", "x_silver_positions")
_register("slv_07_congestion", "silver_congestion", "x_silver_congestion")
_register("slv_08_weather", "silver_weather", "x_silver_weather")

_register("stg_01_routes", "stg_routes", "x_stg_routes")
_register("stg_02_stops", "stg_stops", "x_stg_stops")
_register("stg_03_trips", "stg_trips", "x_stg_trips")
_register("stg_04_stop_times", "stg_stop_times", "x_stg_stop_times")
_register("stg_05_vehicle_positions", "stg_vehicle_positions", "x_stg_positions")
_register("stg_06_congestion", "stg_congestion", "x_stg_congestion")
_register("stg_07_weather", "stg_weather", "x_stg_weather")

_register("int_01_positions_enriched", "int_positions_enriched", "x_enriched")
_register("int_02_delay_by_route_hour", "int_delay_by_route_hour", "x_delay_hours", "delayed_rate")
_register("int_03_daily_transit_delay", "int_daily_transit_delay", "x_delay_days", "delayed_rate")
_register(
    "int_04_congestion_segment_hour",
    "int_congestion_segment_hour",
    "x_road_hours",
    "avg_speed_mph",
    "length_mi",
    "start_lat",
    "start_lon",
)
_register("int_05_daily_congestion", "int_daily_congestion", "x_road_days", "avg_speed_mph", "congestion_index")

_register("dim_04_route", "dim_route", "x_dim_route")
_register("dim_05_stop", "dim_stop", "x_dim_stop")
_register(
    "dim_06_segment", "dim_segment", "x_dim_segment", "length_mi", "start_lat", "start_lon", "end_lat", "end_lon"
)
_register("fct_01_vehicle_position", "fact_vehicle_position", "x_fact_position")
_register("fct_02_trip_delay", "fact_trip_delay", "x_fact_delay")
_register("fct_03_congestion", "fact_congestion", "x_fact_congestion")
_register("fct_04_weather_daily", "fact_weather_daily", "x_fact_weather")

_register("mart_01_otp_by_route", "mart_otp_by_route", "x_otp_route", "on_time_rate")
_register("mart_02_otp_by_mode_hour", "mart_otp_by_mode_hour", "x_otp_mode_hour", "on_time_rate")
_register("mart_03_otp_by_route_hour", "mart_otp_by_route_hour", "x_otp_route_hour", "on_time_rate")
_register("mart_04_fleet_activity_by_route", "mart_fleet_activity_by_route", "x_fleet_activity")
_register("mart_05_daily_delay_trend", "mart_daily_delay_trend", "x_delay_trend", "delayed_rate")
_register("mart_06_delay_vs_weather", "mart_delay_vs_weather", "x_delay_weather", "delayed_rate")
_register(
    "mart_07_delay_vs_congestion",
    "mart_delay_vs_congestion",
    "x_delay_congestion",
    "delayed_rate",
    "road_avg_speed_mph",
)
_register("mart_08_congestion_by_hour", "mart_congestion_by_hour", "x_road_by_hour", "avg_speed_mph")
_register(
    "mart_09_congestion_hotspots",
    "mart_congestion_hotspots",
    "x_hotspots",
    "avg_speed_mph",
    "start_lat",
    "start_lon",
)
_register("mart_10_segment_speed_profile", "mart_segment_speed_profile", "x_speed_profile", "avg_speed_mph")
_register("mart_11_busiest_stops", "mart_busiest_stops", "x_busiest")
_register("mart_12_route_service_levels", "mart_route_service_levels", "x_service")
_register("mart_13_route_summary", "mart_route_summary", "x_route_summary", "on_time_rate")
_register("mart_14_source_freshness", "mart_pipeline_freshness", "x_freshness")
