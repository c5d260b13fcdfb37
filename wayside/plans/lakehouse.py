"""The table graph: landed tables to conformed ones, aggregates, star schema, marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wayside.operators import dimensions, facts, intermediate, marts, silver, staging
from wayside.storage import TableStore


@dataclass(frozen=True)
class Model:
    """How a table is made. Unstored models stay lazy and merge into their readers."""

    make: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    stored: bool = True
    by: tuple[str, ...] = ()


def _lazy(make, *needs: str) -> Model:
    return Model(make, needs, stored=False)


def _table(make, *needs: str, by: tuple[str, ...] = ()) -> Model:
    return Model(make, needs, by=by)


def _positions(bus: DataFrame, trains: DataFrame) -> DataFrame:
    return silver.vehicle_positions(bus, trains, trains_unique=True)


# In dependency order, from the landed tables `bus_positions`, `decoded_trains`,
# `routes`, `stops`, `trips`, `stop_times`, `congestion` and `weather`. Stored
# aggregates are those with several readers: the reports are scanned once for
# `vehicle_hours`, the road observations once for `int_congestion_segment_hour`,
# and every mart reads those.
MODELS: dict[str, Model] = {
    "silver_routes": _table(silver.routes, "routes"),
    "silver_stops": _table(silver.stops, "stops"),
    "silver_trips": _table(silver.trips, "trips"),
    "silver_stop_times": _table(silver.stop_times, "stop_times"),
    "silver_train_positions": _table(silver.train_positions, "decoded_trains"),
    "silver_vehicle_positions": _table(_positions, "bus_positions", "silver_train_positions"),
    "silver_congestion": _table(silver.congestion, "congestion"),
    "silver_weather": _table(silver.weather, "weather"),
    "stg_routes": _lazy(staging.routes, "silver_routes"),
    "stg_stops": _lazy(staging.stops, "silver_stops"),
    "stg_trips": _lazy(staging.trips, "silver_trips"),
    "stg_stop_times": _lazy(staging.stop_times, "silver_stop_times"),
    "stg_vehicle_positions": _lazy(staging.vehicle_positions, "silver_vehicle_positions"),
    "stg_congestion": _lazy(staging.congestion, "silver_congestion"),
    "stg_weather": _lazy(staging.weather, "silver_weather"),
    "int_positions_enriched": _lazy(intermediate.positions_enriched, "stg_vehicle_positions", "stg_routes"),
    "vehicle_hours": _table(intermediate.vehicle_hours, "stg_vehicle_positions"),
    "int_delay_by_route_hour": _table(intermediate.delay_by_route_hour, "vehicle_hours", "stg_routes"),
    "int_daily_transit_delay": _table(intermediate.daily_transit_delay, "vehicle_hours", "stg_routes"),
    "int_congestion_segment_hour": _table(intermediate.congestion_segment_hour, "stg_congestion"),
    "int_daily_congestion": _lazy(intermediate.daily_congestion, "stg_congestion"),
    "dim_date": _table(dimensions.dates),
    "dim_agency": _table(dimensions.agencies),
    "dim_mode": _table(dimensions.modes),
    "dim_route": _table(dimensions.routes, "stg_routes", "vehicle_hours"),
    "dim_stop": _table(dimensions.stops, "stg_stops"),
    "dim_segment": _table(dimensions.segments, "stg_congestion"),
    "fact_vehicle_position": _table(facts.vehicle_position, "int_positions_enriched", by=("report_date",)),
    "fact_trip_delay": _table(facts.trip_delay, "fact_vehicle_position", by=("report_date",)),
    "fact_congestion": _table(facts.congestion, "stg_congestion", by=("report_date",)),
    "fact_weather_daily": _table(facts.weather_daily, "stg_weather"),
    "mart_otp_by_route": _table(marts.otp_by_route, "int_delay_by_route_hour"),
    "mart_otp_by_mode_hour": _table(marts.otp_by_mode_hour, "int_delay_by_route_hour"),
    "mart_otp_by_route_hour": _table(marts.otp_by_route_hour, "int_delay_by_route_hour"),
    "mart_fleet_activity_by_route": _table(marts.fleet_activity_by_route, "int_delay_by_route_hour"),
    "mart_daily_delay_trend": _table(marts.daily_delay_trend, "int_daily_transit_delay", "dim_date"),
    "mart_delay_vs_weather": _table(marts.delay_vs_weather, "int_daily_transit_delay", "fact_weather_daily"),
    "mart_delay_vs_congestion": _table(
        marts.delay_vs_congestion, "int_delay_by_route_hour", "int_congestion_segment_hour"
    ),
    "mart_congestion_by_hour": _table(marts.congestion_by_hour, "int_congestion_segment_hour"),
    "mart_congestion_hotspots": _table(marts.congestion_hotspots, "int_congestion_segment_hour"),
    "mart_segment_speed_profile": _table(marts.segment_speed_profile, "int_congestion_segment_hour"),
    "mart_busiest_stops": _table(marts.busiest_stops, "stg_stop_times", "dim_stop"),
    "mart_route_service_levels": _table(
        marts.route_service_levels, "stg_trips", "stg_stop_times", "stg_routes"
    ),
    "mart_route_summary": _table(marts.route_summary, "dim_route", "mart_otp_by_route"),
    "mart_pipeline_freshness": _table(
        marts.freshness, "fact_vehicle_position", "fact_congestion", "fact_weather_daily"
    ),
}


def derive(spark: SparkSession, given: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One model straight from the given tables, as a single lazy plan.

    `given` may hold landed, conformed or any other tables of the graph.
    """
    made: dict[str, DataFrame] = {}

    def table(wanted: str) -> DataFrame:
        if wanted not in MODELS or wanted in given:
            return given[wanted]
        if wanted not in made:
            made[wanted] = _make(spark, MODELS[wanted], table)
        return made[wanted]

    return table(name)


def _make(spark: SparkSession, model: Model, table: Callable[[str], DataFrame]) -> DataFrame:
    return model.make(*map(table, model.needs)) if model.needs else model.make(spark)


def needed(names: Iterable[str], given: Mapping[str, DataFrame]) -> set[str]:
    """These models and all that they are made from, short of given tables."""
    out, left = set(), list(names)
    while left:
        name = left.pop()
        if name in MODELS and name not in out:
            out.add(name)
            left += () if name in given else MODELS[name].needs
    return out


def build(
    spark: SparkSession,
    given: Mapping[str, DataFrame],
    store: TableStore,
    jobs: int = 8,
    gate: Callable[[str, DataFrame], None] | None = None,
    only: Iterable[str] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write every stored model that is not given; readers get the written one.

    Up to `jobs` models are written at a time, so small ones fill the cores a large
    one leaves idle. A `gate` sees every written table and may raise: models that
    need the table are then not written, independent ones still are, and the error
    is raised at the end. With `only`, just these tables and those they need are
    made. Gives all made tables by name and the row counts of the written ones.
    """
    wanted = set(MODELS if only is None else needed(only, given))
    pending: dict[str, Future] = {}

    def table(name: str) -> DataFrame:
        return pending[name].result()[0] if name in pending else given[name]

    def write(name: str) -> tuple[DataFrame, int | None]:
        model = MODELS[name]
        frame = _make(spark, model, table)
        if not model.stored:
            return frame, None
        count = store.rebuild(name, frame, model.by)
        written = store.read(name, frame.schema)
        if gate:
            gate(name, written)
        return written, count

    # Models only wait for ones submitted before them, which run or have run by then.
    with ThreadPoolExecutor(jobs) as pool:
        for name in MODELS:
            if name in wanted and name not in given:
                pending[name] = pool.submit(write, name)
    done = {name: future.result() for name, future in pending.items()}
    tables = {name: done[name][0] if name in done else given[name] for name in MODELS if name in wanted}
    return tables, {name: count for name, (_, count) in done.items() if count is not None}
