"""What the physical plans must look like whatever the data's size."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from registry.inputs import Landed, model
from wayside.operators import dimensions, intermediate, marts, serving, staging
from wayside.plans import daily
from wayside.plans.lakehouse import MODELS
from wayside.schemas import SILVER
from wayside.sources import landing, open_data
from wayside.storage import TableStore, settle

DATA = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(MODELS) - {"dim_date", "dim_agency", "dim_mode"}))
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    plan = plan_of(model(spark, DATA, name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "InPandas" not in plan
    assert not unkeyed_windows(plan), "a window without keys runs in one task"


def unkeyed_windows(plan: str) -> list[str]:
    """Window definitions that begin with their order or frame: those have no keys.

    The one over `_range` is meant: it adds up a single row from each sort task.
    """
    first = re.findall(r"windowspecdefinition\((.+?)(?:, |\))", plan)
    first = [f for f in first if not f.startswith("_range#")]
    return [f for f in first if f.startswith("specifiedwindowframe") or re.search(r" (ASC|DESC)( NULLS (FIRST|LAST))?$", f)]


def test_a_window_without_keys_is_seen(spark):
    ranked = "SELECT rank() OVER ({}ORDER BY id) AS r FROM range(9)"
    assert unkeyed_windows(plan_of(spark.sql(ranked.format(""))))
    assert unkeyed_windows(plan_of(spark.sql("SELECT sum(id) OVER () AS r FROM range(9)")))
    assert not unkeyed_windows(plan_of(spark.sql(ranked.format("PARTITION BY id % 2 "))))


@pytest.mark.parametrize("name", ["silver_train_positions", "silver_vehicle_positions", "silver_congestion", "silver_weather"])
def test_dedupe_reduces_before_the_exchange(spark, name):
    plan = plan_of(model(spark, DATA, name))
    assert plan.count("row_number(), 1, Partial") == plan.count("row_number(), 1, Final") > 0


def test_unique_trains_skip_the_second_exchange(spark):
    assert plan_of(model(spark, DATA, "silver_vehicle_positions")).count("Exchange hashpartitioning") == 2


def test_marts_read_only_needed_columns(spark):
    plan = plan_of(model(spark, DATA, "mart_busiest_stops"))
    (lineitem,) = [s for s in re.findall(r"ReadSchema: struct<(.*?)>", plan) if "l_orderkey" in s]
    assert "l_extendedprice" not in lineitem and "l_shipdate" not in lineitem


def test_positions_are_scanned_once_per_feed(spark):
    assert plan_of(model(spark, DATA, "int_daily_transit_delay")).count("events.parquet") == 2


def test_reports_are_aggregated_before_they_meet_routes(spark):
    plan = plan_of(model(spark, DATA, "int_delay_by_route_hour"))
    # The tree prints parents first: the join stands above the aggregates.
    assert plan.index("LeftOuter") < plan.index("partial_count(1)")


def test_snapshot_and_time_filters_reach_the_scan(spark, tmp_path):
    bus = Landed(spark, DATA)["bus_positions"].withColumn("dt", F.to_date("_ingested_at"))
    store = TableStore(spark, str(tmp_path))
    store.rebuild("bus", bus, ["dt"])
    assert all("/dt=2024-01-30/" in file for file in landing.newest_snapshot(spark, store.path("bus")).inputFiles())
    store.rebuild("road", Landed(spark, DATA)["congestion"])
    road = plan_of(open_data.congestion_slice(store.read("road"), "2018-02-01"))
    assert "GreaterThanOrEqual(time,2018-02-01)" in road


def test_live_fleet_prunes_days(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.rebuild("fact", model(spark, DATA, "fact_vehicle_position"), ["report_date"])
    plan = plan_of(serving.recent_fleet(store.read("fact")))
    assert re.search(r"PartitionFilters: \[[^\]]*report_date#\d+ >=", plan)


def test_top_lists_are_not_full_sorts(spark):
    plan = plan_of(serving.worst_otp(model(spark, DATA, "mart_otp_by_route")))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_written_days_are_split_and_merged_by_size(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = store.rebuild("fact", model(spark, DATA, "fact_vehicle_position"), ["report_date"])
    assert rows == store.read("fact").count()
    files = list((tmp_path / "fact").glob("report_date=*/part-*.parquet"))
    assert len(files) == 30


def test_a_day_loaded_again_changes_marts_as_a_full_build_does(spark, tmp_path, rows):
    """Days that grow, shrink and go, and a new timetable; only the day's folder is read."""
    routes = spark.createDataFrame([("66", "Chicago"), ("66", "Chicago again")], "route_id string, route_long_name string")
    dates = dimensions.dates(spark)

    def staged(*reports):
        columns = ["CTA", "bus", "v", "66", None, 41.9, -87.6, 0, False, None, None]
        made = []
        for day, hour, vehicle, route, late in reports:
            at = dt.datetime(2024, 1, day, hour)
            made.append((*columns[:2], vehicle, route, *columns[4:8], late, at, at))
        return staging.vehicle_positions(spark.createDataFrame(made, SILVER["silver_vehicle_positions"]))

    def full(reports, names):
        hours = intermediate.vehicle_hours(reports)
        delays, per_day = intermediate.delay_by_route_hour(hours, names), intermediate.daily_transit_delay(hours, names)
        return {"mart_otp_by_route": marts.otp_by_route(delays), "mart_daily_delay_trend": marts.daily_delay_trend(per_day, dates), "mart_fleet_activity_by_route": marts.fleet_activity_by_route(delays)}

    store = TableStore(spark, str(tmp_path / "parts"))
    kept = [(2, 9, "1", "66", True), (2, 9, "2", None, None), (3, 8, "1", "66", False)]
    daily.refresh(store, staged((1, 8, "1", "66", False), *kept))
    now = staged((1, 8, "1", "66", False), (1, 8, "3", "9", True), (1, 23, "1", "66", True), *kept[:2])
    daily.refresh(store, now, [dt.date(2024, 1, 1)])
    daily.refresh(store, now, [dt.date(2024, 1, 3)])
    for names in (routes, routes.limit(0)):
        merged = daily.delay_marts(store, names, dates)
        for name, wanted in full(now, names).items():
            assert rows(merged[name], *wanted.columns) == rows(wanted)
    by_day = settle(now, "by-day", "report_date")
    one = plan_of(by_day.where(F.col("report_date").isin([dt.date(2024, 1, 1)])))
    assert re.search(r"PartitionFilters: \[[^\]]*report_date", one)
