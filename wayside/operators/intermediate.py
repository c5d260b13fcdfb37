"""Shared aggregates between staging and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: speed taken as free flow when a congestion index is formed.
FREE_FLOW_MPH = 30.0


def rate(part: Column, whole: Column) -> Column:
    """Share as a double; NULL instead of a division by zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0).cast("bigint"))


def delayed(flag: str = "is_delayed") -> Column:
    """Number of true flags; NULL counts as not delayed."""
    return F.sum(F.when(F.col(flag), 1).otherwise(0))


def route_names(routes: DataFrame) -> DataFrame:
    """(mode, route_id, name) of timetable routes and how often each is listed.

    Only buses are looked up by name, so the mode is part of the key. `listed` is
    1 for a sound timetable; keeping it lets facts be aggregated first and still
    come out as if they had been joined row by row.
    """
    return routes.groupBy(
        F.lit("bus").alias("mode"),
        "route_id",
        F.coalesce("route_long_name", "route_id").alias("listed_name"),
    ).agg(F.count(F.lit(1)).alias("listed"))


def positions_enriched(positions: DataFrame, routes: DataFrame) -> DataFrame:
    """Each report with its route's name; rail and unknown routes keep their id.

    A left join, so should the timetable outgrow a broadcast, adaptive execution
    still splits the partition of a route that holds a large share of the reports.
    """
    named = routes.select(F.lit("bus").alias("mode"), "route_id", "route_long_name")
    return positions.join(named, ["mode", "route_id"], "left").select(
        "position_sk",
        "agency",
        "mode",
        "vehicle_id",
        "route_id",
        F.coalesce("route_long_name", "route_id").alias("route_name"),
        "headsign",
        "lat",
        "lon",
        "heading",
        "is_delayed",
        "report_ts",
        "report_date",
        "report_hour",
    )


def vehicle_hours(positions: DataFrame) -> DataFrame:
    """Reports per vehicle, route and hour: the one pass over the reports.

    Map tasks already add up their share, so a busy route or hour shuffles as a
    few rows per task. Both delay aggregates start here and never touch the
    reports again; distinct vehicles become plain counts.
    """
    keys = ["agency", "mode", "route_id", "report_date", "report_hour", "vehicle_id"]
    return positions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reports"), delayed().alias("delays")
    )


def _named_hours(hours: DataFrame, routes: DataFrame) -> DataFrame:
    return hours.join(route_names(routes), ["mode", "route_id"], "left").select(
        *hours.columns,
        F.coalesce("listed_name", "route_id").alias("route_name"),
        F.coalesce("listed", F.lit(1).cast("bigint")).alias("listed"),
    )


def delay_by_route_hour(hours: DataFrame, routes: DataFrame) -> DataFrame:
    """Reports, delays and distinct vehicles by route, day and hour."""
    keys = ["agency", "mode", "route_id", "report_date", "report_hour"]
    totals = hours.groupBy(*keys).agg(
        F.sum("reports").alias("reports"),
        F.sum("delays").alias("delays"),
        F.count("vehicle_id").alias("active_vehicles"),
    )
    return named_route_hours(totals, routes)


def named_route_hours(totals: DataFrame, routes: DataFrame) -> DataFrame:
    """Totals by route, day and hour (reports, delays, active_vehicles) with names and rates."""
    return _named_hours(totals, routes).select(
        "agency",
        "mode",
        "route_id",
        "route_name",
        "report_date",
        "report_hour",
        (F.col("reports") * F.col("listed")).alias("report_count"),
        (F.col("delays") * F.col("listed")).alias("delayed_count"),
        "active_vehicles",
        rate(F.col("delays"), F.col("reports")).alias("delayed_rate"),
    )


def daily_transit_delay(hours: DataFrame, routes: DataFrame) -> DataFrame:
    """Reports, delays, distinct vehicles and routes by day and mode.

    Two distinct counts triple their input rows; that input is `vehicle_hours`,
    not the reports.
    """
    daily = _named_hours(hours, routes).groupBy("report_date", "mode").agg(
        F.sum(F.col("reports") * F.col("listed")).alias("report_count"),
        F.sum(F.col("delays") * F.col("listed")).alias("delayed_count"),
        F.countDistinct("vehicle_id").alias("active_vehicles"),
        F.countDistinct("route_id").alias("active_routes"),
    )
    return daily.withColumn("delayed_rate", rate(F.col("delayed_count"), F.col("report_count")))


def congestion_segment_hour(congestion: DataFrame) -> DataFrame:
    """Observations and speeds by segment, day and hour."""
    return congestion.groupBy(
        "segment_id",
        "street",
        "direction",
        "from_street",
        "to_street",
        "report_date",
        "report_hour",
        "day_of_week",
    ).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.avg("speed_mph").alias("avg_speed_mph"),
        F.min("speed_mph").alias("min_speed_mph"),
        F.avg("length_mi").alias("length_mi"),
        F.avg("start_lat").alias("start_lat"),
        F.avg("start_lon").alias("start_lon"),
    )


def daily_congestion(congestion: DataFrame) -> DataFrame:
    """City-wide speed and congestion index (0 = free flow) per day."""
    slowdown = F.lit(1.0) - F.col("speed_mph") / F.lit(FREE_FLOW_MPH)
    return congestion.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.countDistinct("segment_id").alias("active_segments"),
        F.avg("speed_mph").alias("avg_speed_mph"),
        F.avg(F.greatest(F.lit(0.0), slowdown)).alias("congestion_index"),
    )
