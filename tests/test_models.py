from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from registry.inputs import Landed
from wayside.operators import dimensions, facts, intermediate, marts, serving, silver, staging
from wayside.plans import lakehouse
from wayside.plans.rules import ASSERTIONS, TABLE_RULES
from wayside.operators import quality
from wayside.schemas import BRONZE, SILVER, empty_silver, struct
from wayside.storage import TableStore

DATA = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 8, 5)


def _bus(spark, *reports):
    """(vid, rt, lat, lon, dly, tmstmp, _ingested_at)"""
    short = spark.createDataFrame(
        list(reports),
        "vid string, rt string, lat double, lon double, dly boolean, tmstmp timestamp_ntz, _ingested_at timestamp_ntz",
    )
    wide = struct(BRONZE["bus_positions"])
    return short.select(*(
        F.col(f.name) if f.name in short.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wide
    ))


def _decoded(spark, *reports):
    return spark.createDataFrame(list(reports), BRONZE["decoded_trains"])


def _minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_positions_keep_the_earliest_report_in_town(spark, rows):
    bus = _bus(
        spark,
        ("1", "66", 41.9, -87.6, False, T0, _minutes(4)),
        ("1", "66", 41.8, -87.6, True, T0, _minutes(2)),
        ("1", "66", 0.0, 0.0, True, T0, _minutes(1)),
        ("2", "66", 43.0, -89.0, None, T0, _minutes(1)),
        (None, "66", 42.0, -88.0, None, None, _minutes(1)),
        (None, "66", 42.0, -88.0, None, None, None),
        ("3", "66", None, -88.0, None, T0, T0),
    )
    trains = _decoded(
        spark,
        ("1", "red", 41.9, -87.6, 5, False, "30", T0),
        ("9", "red", 0.0, 0.0, 5, False, "30", T0),
    )
    got = silver.vehicle_positions(bus, trains)
    assert got.dtypes == [tuple(part.split(" ")) for part in SILVER["silver_vehicle_positions"].split(", ")]
    assert rows(got, "mode", "vehicle_id", "lat", "report_ts", "_ingested_at") == [
        ("bus", "1", 41.8, T0, _minutes(2)),
        ("bus", "2", 43.0, T0, _minutes(1)),
        ("bus", None, 42.0, None, _minutes(1)),
        ("train", "1", 41.9, T0, T0),
    ]
    assert rows(got) == rows(silver.vehicle_positions(bus, silver.train_positions(trains), trains_unique=True))


def test_trains_are_deduplicated_before_the_box(spark, rows):
    trains = _decoded(spark, ("1", "red", 0.0, 0.0, 5, False, "30", T0), ("1", "red", 41.9, -87.6, 5, False, "30", T0))
    unique = silver.train_positions(trains)
    assert unique.count() == 1
    assert silver.vehicle_positions(_bus(spark), unique, trains_unique=True).count() == 0


def test_congestion_keys_are_raw_text(spark, rows):
    base = {f.name: None for f in struct(BRONZE["congestion"])}
    at = {"time": "2018-02-01T10:00:00.000", "_ingested_at": T0}
    given = [
        {**base, **at, "segment_id": "1", "speed": "20"},
        {**base, **at, "segment_id": "01", "speed": "21"},
        {**base, **at, "segment_id": "1", "speed": "99", "_ingested_at": _minutes(1)},
        {**base, **at, "segment_id": "2", "speed": "-1"},
        {**base, **at, "segment_id": "3", "speed": None},
        {**base, **at, "segment_id": "4", "speed": "slow"},
        {**base, **at, "segment_id": "x", "speed": "0"},
    ]
    raw = spark.createDataFrame(given, BRONZE["congestion"] + ", _ingested_at timestamp_ntz")
    assert rows(silver.congestion(raw), "segment_id", "speed_mph") == [(1, 20), (1, 21), (None, 0)]


def test_bad_time_stops_congestion(spark):
    base = {f.name: None for f in struct(BRONZE["congestion"])}
    raw = spark.createDataFrame(
        [{**base, "segment_id": "1", "speed": "3", "time": "noon", "_ingested_at": T0}],
        BRONZE["congestion"] + ", _ingested_at timestamp_ntz")
    with pytest.raises(Exception):
        silver.congestion(raw).collect()


def _staged(spark):
    reports = []
    for i in range(400):
        route = "66" if i % 3 == 0 else str(60 + i % 9)
        reports.append((str(i % 17) if i % 50 else None, route if i % 70 else None, 41.9, -87.6,
                        [True, False, None][i % 3 if i % 4 else 1], _minutes(i * 7 % 900), T0))
    trains = [(str(i % 5), "66", 41.9, -87.6, 1, i % 2 == 0, "1", _minutes(i)) for i in range(60)]
    positions = staging.vehicle_positions(silver.vehicle_positions(_bus(spark, *reports), _decoded(spark, *trains)))
    # A timetable with a repeated route, two names for one id, and a missing name.
    routes = spark.createDataFrame(
        [("66", "Chicago"), ("66", "Chicago"), ("66", "Chicago Av"), ("61", None), ("62", "Harlem"), (None, "Nowhere")],
        "route_id string, route_long_name string",
    )
    blank = {c: F.lit(None).cast("string") for c in ("agency", "route_short_name", "route_color", "route_text_color")}
    routes = staging.routes(routes.withColumns(blank).withColumn("route_type", F.lit(3)))
    return positions, routes


def test_aggregating_before_the_join_changes_nothing(spark, rows):
    positions, routes = _staged(spark)
    joined = intermediate.positions_enriched(positions, routes)
    late = F.sum(F.when(F.col("is_delayed"), 1).otherwise(0)).alias("delayed_count")
    keys = ["agency", "mode", "route_id", "route_name", "report_date", "report_hour"]
    naive_hours = joined.groupBy(*keys).agg(
        F.count("*").alias("report_count"), late, F.countDistinct("vehicle_id").alias("active_vehicles"))
    naive_days = joined.groupBy("report_date", "mode").agg(
        F.count("*").alias("report_count"), late, F.countDistinct("vehicle_id").alias("active_vehicles"),
        F.countDistinct("route_id").alias("active_routes"))
    hours = intermediate.vehicle_hours(positions)
    assert rows(intermediate.delay_by_route_hour(hours, routes), *naive_hours.columns) == rows(naive_hours)
    assert rows(intermediate.daily_transit_delay(hours, routes), *naive_days.columns) == rows(naive_days)


def test_rail_routes_never_take_bus_names(spark, rows):
    positions, routes = _staged(spark)
    named = intermediate.positions_enriched(positions, routes).where("mode = 'train'")
    assert rows(named.select("route_name").distinct()) == [("66",)]
    dim = dimensions.routes(routes, positions)
    assert rows(dim.where("route_id = '66'"), "mode", "route_name", "route_type_name") == [
        ("bus", "Chicago", "bus"), ("bus", "Chicago Av", "bus"), ("train", "66", "subway")]


def test_unknown_flag_is_no_delay(spark, rows):
    positions, routes = _staged(spark)
    fact = facts.vehicle_position(intermediate.positions_enriched(positions, routes))
    assert facts.trip_delay(fact).count() == fact.where("is_delayed = true").count()
    assert facts.trip_delay(fact).columns == [c for c in fact.columns if c not in ("heading", "is_delayed")]


def _hours(spark, *cells):
    """(segment, hour, speed)"""
    df = spark.createDataFrame(list(cells), "segment_id int, report_hour int, avg_speed_mph double")
    text = {c: F.concat(F.lit(f"{c} "), F.col("segment_id").cast("string")) for c in ("street", "direction", "from_street", "to_street")}
    return df.withColumns(text).withColumns({
        "report_date": F.lit(dt.date(2018, 1, 1)), "day_of_week": F.lit(1), "observation_count": F.lit(2).cast("bigint"),
        "min_speed_mph": F.lit(1), "length_mi": F.lit(0.5), "start_lat": F.lit(41.5), "start_lon": F.lit(-87.5)})


def test_hotspots(spark, rows):
    cells = _hours(spark, (1, 9, 10.0), (1, 8, 10.0), (1, 7, 20.0), (2, 1, 30.0), (3, None, 5.0), (3, 4, 75.0), (None, 6, 2.0))
    got = marts.congestion_hotspots(cells)
    assert rows(got, "congestion_rank", "segment_id", "worst_hour", "observations") == [
        (1, None, None, 2), (2, 1, 8, 6), (3, 2, 1, 2), (4, 3, None, 4)]
    assert [r.congestion_rank for r in got.collect()] == [1, 2, 3, 4]


def test_hotspot_ties_share_a_rank(spark, rows):
    cells = _hours(spark, *((s, 1, 10.0 if s % 3 else 5.0) for s in range(30)))
    ranks = rows(marts.congestion_hotspots(cells).groupBy("congestion_rank").count())
    assert ranks == [(1, 10), (11, 20)]


def test_congestion_by_hour_is_unweighted(spark, rows):
    cells = _hours(spark, (1, 8, 10.0), (2, 8, 30.0)).withColumn("observation_count", F.col("segment_id").cast("bigint") * 100)
    assert rows(marts.congestion_by_hour(cells)) == [(8, 2, 300, 20.0)]


def test_segment_labels_skip_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "NB", 1.0), (1, "Clark", None, None), (1, "Clark", "NB", 4.0), (2, None, None, None)],
        "segment_id int, street string, direction string, length_mi double",
    )
    rest = {c: F.lit(None).cast("string") for c in ("from_street", "to_street")}
    rest |= {c: F.lit(None).cast("double") for c in ("start_lat", "start_lon", "end_lat", "end_lon")}
    got = dimensions.segments(df.withColumns(rest))
    assert rows(got, "segment_id", "street", "direction", "length_mi") == [(1, "Clark", "NB", 2.5), (2, None, None, None)]


def test_service_levels_with_unknown_routes_and_repeats(spark, rows):
    trips = spark.createDataFrame(
        [("t1", "66", "wk", "a"), ("t2", "66", "wk", "b"), ("t2", "66", "sa", "b"), ("t3", "99", "wk", None), ("t4", None, "wk", "c")],
        "trip_id string, route_id string, service_id string, shape_id string")
    stop_times = spark.createDataFrame([("t1",), ("t1",), ("t2",), ("t9",)], "trip_id string")
    routes = spark.createDataFrame([("66", "Chicago"), ("66", "Chicago")], "route_id string, route_long_name string")
    got = marts.route_service_levels(trips, stop_times, routes)
    assert rows(got) == [("66", "Chicago", 2, 2, 2, 8), ("99", None, 1, 1, 0, 0), (None, None, 1, 1, 1, 0)]


def test_busiest_stops_only_lists_known_stops(spark, rows):
    times = spark.createDataFrame([("a", "t1"), ("a", "t1"), ("a", "t2"), ("b", "t1"), ("c", "t1")], "stop_id string, trip_id string")
    stops = spark.createDataFrame([("a", "A", 41.0, -87.0), ("b", "B", 41.5, -87.5)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    got = marts.busiest_stops(times, stops)
    assert [tuple(r) for r in got.collect()] == [("a", "A", 41.0, -87.0, 3, 2), ("b", "B", 41.5, -87.5, 1, 1)]


def test_the_window_of_the_recent_fleet(spark, rows):
    """Reports 6 and 29 minutes old are recent in half an hour, not in five minutes."""
    newest = dt.datetime(2024, 1, 1, 0, 10)
    ages = [0, 5, 6, 29, 31]
    made = [("bus", str(m), 41.9, -87.6, False, newest - dt.timedelta(minutes=m)) for m in ages]
    frame = spark.createDataFrame(made, "mode string, route_id string, lat double, lon double, is_delayed boolean, report_ts timestamp_ntz")
    frame = frame.withColumn("report_date", F.to_date("report_ts"))
    assert rows(serving.recent_fleet(frame), "route_id") == [("0",), ("5",)]
    assert rows(serving.recent_fleet(frame, 30), "route_id") == [("0",), ("29",), ("5",), ("6",)]


def test_recent_fleet_and_map_points(spark, rows):
    cols = "mode string, route_id string, lat double, lon double, is_delayed boolean, report_ts timestamp_ntz"
    at = [("bus", "1", 41.0, -87.0, False, T0), ("bus", "2", float("nan"), -87.0, None, _minutes(-5)), ("bus", "3", None, -87.0, True, _minutes(-6))]
    positions = spark.createDataFrame(at, cols).withColumn("report_date", F.to_date("report_ts"))
    recent = serving.recent_fleet(positions)
    assert sorted(r.route_id for r in recent.collect()) == ["1", "2"]
    assert rows(serving.map_points(recent), "route_id") == [("1",)]


def test_empty_tables_run_through_every_model_and_check(spark, tmp_path):
    given = empty_silver(spark)
    given["silver_train_positions"] = spark.createDataFrame([], BRONZE["decoded_trains"])
    tables, counts = lakehouse.build(spark, given, TableStore(spark, str(tmp_path)))
    assert counts["fact_congestion"] == 0 and counts["dim_date"] == 3287
    results = quality.check_tables(TABLE_RULES, tables).collect()
    assert len(results) == 91 and all(r.passed for r in results)
    assert all(a.run(a.name, tables[a.table]).first().passed for a in ASSERTIONS)


def test_built_tables_equal_lazy_ones(spark, tmp_path, rows):
    landed = Landed(spark, DATA)
    tables, counts = lakehouse.build(spark, landed, TableStore(spark, str(tmp_path)))
    for name in ("fact_vehicle_position", "int_delay_by_route_hour", "mart_route_summary", "mart_pipeline_freshness"):
        lazy = lakehouse.derive(spark, landed, name)
        assert rows(tables[name].select(*lazy.columns)) == rows(lazy)
        assert counts[name] == lazy.count()
    days = [p.name for p in (tmp_path / "fact_vehicle_position").iterdir() if p.is_dir()]
    assert len(days) == 30 and all(d.startswith("report_date=2024-01-") for d in days)
