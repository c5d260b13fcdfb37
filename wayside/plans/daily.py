"""Delay aggregates and marts brought up to date by day.

A route's hour belongs to one day, and so do a day's distinct vehicles and routes. Parts of a
day are therefore final once its reports are: a day that is loaded again replaces its parts,
which reads that day's reports alone, and the marts are merged from the parts of all days.
Parts hold no names, so that a new timetable reaches every day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayside.operators import marts
from wayside.operators.intermediate import named_route_hours, rate, vehicle_hours
from wayside.storage import TableStore, settle

HOURS, MODES = "delay_parts/route_hours", "delay_parts/modes"
_ROUTE_HOUR = ["agency", "mode", "route_id", "report_date", "report_hour"]


def refresh(store: TableStore, positions: DataFrame, days: Sequence[dt.date] | None = None) -> None:
    """Replace the parts of some days, or of all, by what the staged reports say now; a rerun changes nothing.

    With `positions` stored by report_date, only those days are read. A day without a report
    any more loses its parts.
    """
    if days is not None:
        positions = positions.where(F.col("report_date").isin(list(days)))
    hours = settle(vehicle_hours(positions), "day-hours")
    totals = hours.groupBy(*_ROUTE_HOUR).agg(
        F.sum("reports").alias("reports"), F.sum("delays").alias("delays"), F.count("vehicle_id").alias("active_vehicles")
    )
    modes = hours.groupBy("report_date", "mode").agg(
        F.countDistinct("vehicle_id").alias("active_vehicles"), F.countDistinct("route_id").alias("active_routes")
    )
    for name, parts in ((HOURS, totals), (MODES, modes)):
        store.reload_days(name, parts, ["report_date"])
    if days is not None:
        left = {r["report_date"] for r in hours.select("report_date").distinct().collect()}
        for day in set(days) - left:
            for name in (HOURS, MODES):
                store.drop(f"{name}/report_date={day}")


def route_hours(store: TableStore, routes: DataFrame) -> DataFrame:
    """Reports, delays and distinct vehicles by route, day and hour."""
    return named_route_hours(store.read(HOURS), routes)


def days(store: TableStore, routes: DataFrame) -> DataFrame:
    """Reports, delays, distinct vehicles and routes by day and mode."""
    sums = route_hours(store, routes).groupBy("report_date", "mode").agg(
        F.sum("report_count").alias("report_count"), F.sum("delayed_count").alias("delayed_count")
    )
    both = sums.alias("s").join(store.read(MODES).alias("m"), [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in ("report_date", "mode")])
    named = both.select("s.*", "active_vehicles", "active_routes")
    return named.withColumn("delayed_rate", rate(F.col("delayed_count"), F.col("report_count")))


def delay_marts(store: TableStore, routes: DataFrame, dates: DataFrame) -> dict[str, DataFrame]:
    """The five marts of delays, from the parts."""
    delays = route_hours(store, routes)
    return {
        "mart_otp_by_route": marts.otp_by_route(delays),
        "mart_otp_by_mode_hour": marts.otp_by_mode_hour(delays),
        "mart_otp_by_route_hour": marts.otp_by_route_hour(delays),
        "mart_fleet_activity_by_route": marts.fleet_activity_by_route(delays),
        "mart_daily_delay_trend": marts.daily_delay_trend(days(store, routes), dates),
    }
