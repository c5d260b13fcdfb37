"""Marts merged from day parts after two days were loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import query
from registry.inputs import model, rounded
from registry.parts import whole
from wayside.plans import daily
from wayside.storage import TableStore, fresh_folder, settle

_STORES: dict[tuple[str, str], TableStore] = {}


def _parts(spark: SparkSession, sf_dir: str) -> TableStore:
    """Parts of all reports but the last day's and every other hour of the first; then those two days again."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        store = TableStore(spark, fresh_folder(spark, "day-parts"))
        reports = settle(model(spark, sf_dir, "stg_vehicle_positions"), "positions", "report_date")
        first, last = reports.agg(F.min("report_date"), F.max("report_date")).first()
        early = (F.col("report_date") == first) & (F.col("report_hour") % 2 == 0)
        daily.refresh(store, reports.where(F.coalesce(~early & (F.col("report_date") < last), F.lit(True))))
        for day in (first, last):
            daily.refresh(store, reports, [day])
        _STORES[key] = store
    return _STORES[key]


def _register(name: str, table: str, part: str, *doubles: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = daily.delay_marts(_parts(spark, sf_dir), model(spark, sf_dir, "stg_routes"), model(spark, sf_dir, "dim_date"))
        return rounded(found[table], *doubles)

    query(name, whole(part, *doubles))(run)


_register("mart_01_otp_by_route_from_days", "mart_otp_by_route", "x_otp_route", "on_time_rate")
_register("mart_02_otp_by_mode_hour_from_days", "mart_otp_by_mode_hour", "x_otp_mode_hour", "on_time_rate")
_register("mart_03_otp_by_route_hour_from_days", "mart_otp_by_route_hour", "x_otp_route_hour", "on_time_rate")
_register("mart_04_fleet_activity_from_days", "mart_fleet_activity_by_route", "x_fleet_activity")
_register("mart_05_daily_delay_trend_from_days", "mart_daily_delay_trend", "x_delay_trend", "delayed_rate")


@query("int_02_route_hours_from_days", whole("x_delay_hours", "delayed_rate"))
def route_hours(spark, sf_dir):
    return rounded(daily.route_hours(_parts(spark, sf_dir), model(spark, sf_dir, "stg_routes")), "delayed_rate")


@query("int_03_days_from_days", whole("x_delay_days", "delayed_rate"))
def days(spark, sf_dir):
    return rounded(daily.days(_parts(spark, sf_dir), model(spark, sf_dir, "stg_routes")), "delayed_rate")
