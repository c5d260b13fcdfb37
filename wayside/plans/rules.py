"""Declared checks: table rules, expectation suites, assertions.

Fixed values: columns, limits and value lists every load is held to.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from wayside.functions.boxes import LAT_MAX, LAT_MIN, LON_MAX, LON_MIN
from wayside.operators.quality import (
    BETWEEN,
    IN_SET,
    NOT_NULL,
    ROW_COUNT,
    Expectation,
    Rule,
    accepted_values,
    in_range,
    no_duplicate_keys,
    not_null,
    relationships,
    unique,
    zero_violations,
)
from wayside.operators.staging import OTHER_TYPE, ROUTE_TYPES

MODES = ["bus", "train"]
RAIL_LINES = ["red", "blue", "brn", "g", "org", "p", "pink", "y"]


def _key(column: str) -> list[Rule]:
    return [not_null(column), unique(column)]


def _in_town(lat: str, lon: str) -> list[Rule]:
    return [in_range(lat, LAT_MIN, LAT_MAX), in_range(lon, LON_MIN, LON_MAX)]


def _share(column: str) -> list[Rule]:
    return [in_range(column, 0, 1)]


def _hour(column: str = "report_hour") -> list[Rule]:
    return [in_range(column, 0, 23)]


def _child(column: str, parent: str, field: str | None = None) -> list[Rule]:
    return [relationships(column, parent, field or column)]


TABLE_RULES: dict[str, list[Rule]] = {
    "stg_routes": [
        *_key("route_id"),
        accepted_values("route_type_name", [*ROUTE_TYPES.values(), OTHER_TYPE]),
    ],
    "stg_stops": [*_key("stop_id"), not_null("stop_lat"), not_null("stop_lon")],
    "stg_trips": [*_key("trip_id"), not_null("route_id"), *_child("route_id", "stg_routes")],
    "stg_stop_times": [
        not_null("trip_id"),
        *_child("trip_id", "stg_trips"),
        not_null("stop_id"),
        *_child("stop_id", "stg_stops"),
        accepted_values("scheduled_hour", range(24)),
    ],
    "stg_vehicle_positions": [
        *_key("position_sk"),
        not_null("mode"),
        accepted_values("mode", MODES),
        not_null("report_ts"),
    ],
    "stg_congestion": [not_null("segment_id"), not_null("speed_mph")],
    "stg_weather": _key("weather_date"),
    "dim_date": [*_key("date_day"), *_key("date_key")],
    "dim_agency": _key("agency"),
    "dim_mode": [*_key("mode"), accepted_values("mode", MODES)],
    "dim_route": [*_key("route_sk"), not_null("route_id"), accepted_values("mode", MODES)],
    "dim_stop": [*_key("stop_sk"), *_key("stop_id"), *_in_town("stop_lat", "stop_lon")],
    "dim_segment": [*_key("segment_id"), *_key("segment_sk"), *_in_town("start_lat", "start_lon")],
    "fact_vehicle_position": [
        *_key("position_sk"),
        not_null("route_sk"),
        *_child("route_sk", "dim_route"),
        *_child("date_key", "dim_date"),
        accepted_values("mode", MODES),
        *_in_town("lat", "lon"),
        *_hour(),
    ],
    "fact_trip_delay": [
        *_key("position_sk"),
        not_null("route_sk"),
        *_child("route_sk", "dim_route"),
        *_child("date_key", "dim_date"),
    ],
    "fact_congestion": [
        *_key("congestion_sk"),
        not_null("segment_sk"),
        *_child("segment_sk", "dim_segment"),
        *_child("date_key", "dim_date"),
        in_range("speed_mph", 0, 80),
        *_hour(),
    ],
    "fact_weather_daily": [
        *_key("date_key"),
        *_child("weather_date", "dim_date", "date_day"),
        in_range("temp_max_c", -40, 50),
        in_range("precip_mm", 0, 500),
    ],
    "mart_otp_by_route": [not_null("route_id"), *_share("on_time_rate")],
    "mart_otp_by_mode_hour": [*_hour(), *_share("on_time_rate")],
    "mart_otp_by_route_hour": [*_hour(), *_share("on_time_rate")],
    "mart_congestion_hotspots": [*_key("segment_id"), in_range("avg_speed_mph", 0, 80)],
    "mart_congestion_by_hour": [not_null("report_hour"), *_hour(), in_range("avg_speed_mph", 0, 80)],
    "mart_daily_delay_trend": _share("delayed_rate"),
    "mart_delay_vs_weather": _share("delayed_rate"),
    "mart_delay_vs_congestion": _hour(),
}


def rules_of(kind: str) -> dict[str, list[Rule]]:
    """The declared rules of one kind, by table."""
    chosen = {table: [r for r in rules if r.kind == kind] for table, rules in TABLE_RULES.items()}
    return {table: rules for table, rules in chosen.items() if rules}


SUITES: dict[str, list[Expectation]] = {
    "bronze_vehicle_positions": [
        Expectation(ROW_COUNT, low=1),
        *(Expectation(NOT_NULL, c) for c in ("vid", "rt", "tmstmp")),
        Expectation(BETWEEN, "lat", LAT_MIN, LAT_MAX),
        Expectation(BETWEEN, "lon", LON_MIN, LON_MAX),
        Expectation(BETWEEN, "hdg", 0, 360),
    ],
    # Trains report 0/0 until they have a position, so a fifth may be outside.
    "bronze_train_positions": [
        Expectation(ROW_COUNT, low=1),
        *(Expectation(NOT_NULL, c) for c in ("rn", "rt")),
        Expectation(BETWEEN, "lat", LAT_MIN, LAT_MAX, mostly=0.8),
        Expectation(BETWEEN, "lon", LON_MIN, LON_MAX, mostly=0.8),
        Expectation(IN_SET, "rt", values=tuple(RAIL_LINES)),
    ],
    "silver_congestion": [
        Expectation(ROW_COUNT, low=1),
        *(Expectation(NOT_NULL, c) for c in ("segment_id", "report_ts")),
        Expectation(BETWEEN, "speed_mph", 0, 80),
        Expectation(BETWEEN, "hour", 0, 23),
    ],
    "silver_weather": [
        Expectation(NOT_NULL, "weather_date"),
        Expectation(BETWEEN, "temp_max_c", -40, 50),
        Expectation(BETWEEN, "precip_mm", 0, 500),
    ],
}

# Suites whose failure must stop the load of what depends on the table.
BLOCKING_SUITES = ["bronze_vehicle_positions", "bronze_train_positions"]


@dataclass(frozen=True)
class Assertion:
    name: str
    table: str
    run: Callable[[str, DataFrame], DataFrame]
    blocking: bool = False


def _none_where(predicate: str) -> Callable[[str, DataFrame], DataFrame]:
    return lambda name, df: zero_violations(name, df, predicate)


def _distinct(*keys: str) -> Callable[[str, DataFrame], DataFrame]:
    return lambda name, df: no_duplicate_keys(name, df, keys)


def _outside(lat: str, lon: str) -> str:
    return f"{lat} not between {LAT_MIN} and {LAT_MAX} or {lon} not between {LON_MIN} and {LON_MAX}"


ASSERTIONS = [
    Assertion("positions_coords_valid", "silver_vehicle_positions", _none_where(_outside("lat", "lon")), True),
    Assertion("positions_vehicle_id_not_null", "silver_vehicle_positions", _none_where("vehicle_id is null")),
    Assertion("positions_mode_valid", "silver_vehicle_positions", _none_where("mode not in ('bus', 'train')")),
    Assertion(
        "positions_no_duplicate_reports", "silver_vehicle_positions", _distinct("mode", "vehicle_id", "report_ts")
    ),
    Assertion("routes_unique", "silver_routes", _distinct("route_id")),
    Assertion("stops_coords_valid", "silver_stops", _none_where(_outside("stop_lat", "stop_lon"))),
    Assertion("congestion_speed_nonneg", "silver_congestion", _none_where("speed_mph < 0")),
    Assertion("weather_date_unique", "silver_weather", _distinct("weather_date")),
]
