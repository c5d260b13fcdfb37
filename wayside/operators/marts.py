"""Analytic marts. All start from aggregates, none goes back to the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayside.functions.ranking import global_rank
from wayside.operators.intermediate import rate

_ROUTE = ["agency", "mode", "route_id", "route_name"]


def _totals() -> list[Column]:
    return [F.sum("report_count").alias("total_reports"), F.sum("delayed_count").alias("delayed_reports")]


def _with_on_time(df: DataFrame) -> DataFrame:
    late = rate(F.col("delayed_reports"), F.col("total_reports"))
    return df.withColumn("on_time_rate", F.lit(1.0) - late)


def otp_by_route(delays: DataFrame) -> DataFrame:
    """Share of reports on time per route, worst first."""
    routes = delays.groupBy(*_ROUTE).agg(*_totals(), F.max("active_vehicles").alias("peak_vehicles"))
    return _with_on_time(routes).orderBy(F.col("on_time_rate").asc_nulls_last())


def otp_by_mode_hour(delays: DataFrame) -> DataFrame:
    hours = _with_on_time(delays.groupBy("mode", "report_hour").agg(*_totals()))
    return hours.orderBy(F.col("mode").asc_nulls_last(), F.col("report_hour").asc_nulls_last())


def otp_by_route_hour(delays: DataFrame) -> DataFrame:
    return _with_on_time(delays.groupBy(*_ROUTE, "report_hour").agg(*_totals()))


def fleet_activity_by_route(delays: DataFrame) -> DataFrame:
    return delays.groupBy(*_ROUTE, "report_date").agg(
        F.max("active_vehicles").alias("peak_vehicles"), F.sum("report_count").alias("reports")
    )


def daily_delay_trend(daily: DataFrame, dates: DataFrame) -> DataFrame:
    days = dates.select(F.col("date_day").alias("report_date"), "day_name", "is_weekend")
    return (
        daily.join(days, "report_date", "left")
        .select(
            "report_date",
            "day_name",
            "is_weekend",
            "mode",
            "report_count",
            "delayed_count",
            "delayed_rate",
            "active_vehicles",
            "active_routes",
        )
        .orderBy(F.col("report_date").asc_nulls_last(), F.col("mode").asc_nulls_last())
    )


def delay_vs_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    measures = ["temp_avg_c", "precip_mm", "snow_cm", "wind_kmh", "is_wet_day", "is_snow_day"]
    days = weather.select(F.col("weather_date").alias("report_date"), *measures)
    return (
        daily.join(days, "report_date", "left")
        .select("report_date", "mode", "report_count", "delayed_count", "delayed_rate", "active_vehicles", *measures)
        .orderBy(F.col("report_date").asc_nulls_last(), F.col("mode").asc_nulls_last())
    )


def delay_vs_congestion(delays: DataFrame, segment_hours: DataFrame) -> DataFrame:
    """Delay rate beside road speed by hour of day; the two calendars need not overlap."""
    transit = delays.groupBy("report_hour").agg(
        F.sum("report_count").alias("transit_reports"), F.sum("delayed_count").alias("_delayed")
    )
    road = segment_hours.groupBy("report_hour").agg(
        F.avg("avg_speed_mph").alias("road_avg_speed_mph"), F.count(F.lit(1)).alias("segment_hours")
    )
    return (
        transit.join(road, "report_hour", "left")
        .select(
            "report_hour",
            "transit_reports",
            rate(F.col("_delayed"), F.col("transit_reports")).alias("delayed_rate"),
            "road_avg_speed_mph",
            "segment_hours",
        )
        .orderBy(F.col("report_hour").asc_nulls_last())
    )


def congestion_by_hour(segment_hours: DataFrame) -> DataFrame:
    """Speed by hour; every segment-hour weighs the same, on purpose."""
    return (
        segment_hours.groupBy("report_hour")
        .agg(
            F.countDistinct("segment_id").alias("segments"),
            F.sum("observation_count").alias("observations"),
            F.avg("avg_speed_mph").alias("avg_speed_mph"),
        )
        .orderBy(F.col("report_hour").asc_nulls_last())
    )


def congestion_hotspots(segment_hours: DataFrame) -> DataFrame:
    """Segments from slowest to fastest, with the hour of their slowest cell.

    Averages and slowest cell come from one aggregate, so nothing is joined back.
    Equally slow cells go to the earliest hour. Segments without an id have no
    worst hour.
    """
    cell = F.struct(
        F.col("avg_speed_mph").isNull(), "avg_speed_mph", F.col("report_hour").isNull(), "report_hour"
    )
    segments = segment_hours.groupBy("segment_id").agg(
        F.min("street").alias("street"),
        F.min("from_street").alias("from_street"),
        F.min("to_street").alias("to_street"),
        F.sum("observation_count").alias("observations"),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.min_by("report_hour", cell).alias("_hour"),
        F.avg("start_lat").alias("start_lat"),
        F.avg("start_lon").alias("start_lon"),
    )
    segments = segments.select(
        "segment_id",
        "street",
        "from_street",
        "to_street",
        "observations",
        "avg_speed_mph",
        F.when(F.col("segment_id").isNotNull(), F.col("_hour")).alias("worst_hour"),
        "start_lat",
        "start_lon",
    )
    return global_rank(segments, "avg_speed_mph", "congestion_rank").orderBy("congestion_rank")


def segment_speed_profile(segment_hours: DataFrame) -> DataFrame:
    return segment_hours.groupBy("segment_id", "street", "report_hour").agg(
        F.sum("observation_count").alias("observations"),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.min("min_speed_mph").alias("min_speed_mph"),
    )


def busiest_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Scheduled departures and distinct trips per stop, busiest first.

    The timetable shrinks to one row per stop before the join, so a stop with a
    third of all departures joins as a single row.
    """
    visits = stop_times.groupBy("stop_id").agg(
        F.count(F.lit(1)).alias("_visits"), F.countDistinct("trip_id").alias("distinct_trips")
    )
    place = ["stop_id", "stop_name", "stop_lat", "stop_lon"]
    listed = stops.groupBy(*place).agg(F.count(F.lit(1)).alias("_listed"))
    return (
        visits.join(listed, "stop_id")
        .select(*place, (F.col("_visits") * F.col("_listed")).alias("scheduled_departures"), "distinct_trips")
        .orderBy(F.col("scheduled_departures").desc_nulls_last())
    )


def route_service_levels(trips: DataFrame, stop_times: DataFrame, routes: DataFrame) -> DataFrame:
    """Scheduled trips, service patterns, shapes and stop events per route.

    Distinct values are counted on rows already reduced to one for each trip, and to one
    for each pattern and shape, so that no count multiplies the trips.
    """
    events = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("_events"))
    each = trips.join(events, "trip_id", "left").groupBy("route_id", "trip_id").agg(F.sum(F.coalesce("_events", F.lit(0))).alias("_events"))
    counted = each.groupBy("route_id").agg(F.count("trip_id").alias("scheduled_trips"), F.sum("_events").alias("_events"))
    kinds = trips.select("route_id", "service_id", "shape_id").distinct().groupBy(F.col("route_id").alias("_of")).agg(
        F.countDistinct("service_id").alias("service_patterns"), F.countDistinct("shape_id").alias("shapes")
    )
    levels = counted.join(kinds, F.col("route_id").eqNullSafe(F.col("_of"))).drop("_of")
    names = routes.groupBy("route_id", "route_long_name").agg(F.count(F.lit(1)).alias("_listed"))
    return (
        levels.join(names, "route_id", "left")
        .groupBy("route_id", F.col("route_long_name").alias("route_name"))
        .agg(
            F.max("scheduled_trips").alias("scheduled_trips"),
            F.max("service_patterns").alias("service_patterns"),
            F.max("shapes").alias("shapes"),
            F.sum(F.col("_events") * F.coalesce("_listed", F.lit(1))).alias("total_stop_events"),
        )
        .orderBy(F.col("scheduled_trips").desc_nulls_last())
    )


def route_summary(routes: DataFrame, otp: DataFrame) -> DataFrame:
    """Every known route with its on-time record, zeros where none was seen."""
    record = otp.select("mode", "route_id", "total_reports", "delayed_reports", "peak_vehicles", "on_time_rate")
    zero = F.lit(0).cast("bigint")
    return routes.join(record, ["mode", "route_id"], "left").select(
        "route_sk",
        "agency",
        "mode",
        "route_id",
        "route_name",
        "route_type_name",
        F.coalesce("total_reports", zero).alias("total_reports"),
        F.coalesce("delayed_reports", zero).alias("delayed_reports"),
        "peak_vehicles",
        "on_time_rate",
    )


def freshness(positions: DataFrame, congestion: DataFrame, weather: DataFrame) -> DataFrame:
    """Newest timestamp and row count of each fact.

    The delayed reports are a part of the position fact, so both rows come from
    one pass over it.
    """
    late = F.when(F.col("is_delayed"), F.col("report_ts"))
    seen = positions.agg(
        F.max("report_ts").alias("seen_ts"),
        F.count(F.lit(1)).alias("seen_rows"),
        F.max(late).alias("late_ts"),
        F.count_if("is_delayed").alias("late_rows"),
    )

    def row(source: str, stamp: str, rows: str) -> Column:
        return F.struct(F.lit(source).alias("source"), F.col(stamp).alias("latest_ts"), F.col(rows).alias("row_count"))

    reports = seen.select(
        F.inline(F.array(row("vehicle_positions", "seen_ts", "seen_rows"), row("trip_delay", "late_ts", "late_rows")))
    )

    def summary(source: str, fact: DataFrame, stamp: Column) -> DataFrame:
        return fact.agg(F.max(stamp).alias("latest_ts"), F.count(F.lit(1)).alias("row_count")).select(
            F.lit(source).alias("source"), "latest_ts", "row_count"
        )

    return reports.unionByName(summary("congestion", congestion, F.col("report_ts"))).unionByName(
        summary("weather", weather, F.col("weather_date").cast("timestamp_ntz"))
    )
