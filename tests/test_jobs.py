"""From landed response files to marts, exports and live tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from registry import raw_files
from wayside.operators import quality, sinks
from wayside.plans import jobs, lakehouse
from wayside.plans.rules import ASSERTIONS, SUITES
from wayside.storage import TableStore
from wayside.streaming import states

pytest.importorskip("google.protobuf")

DATA = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 6, 1, 12, 0, 0)


def _poll(folder, body):
    folder.mkdir(parents=True)
    (folder / "poll.json").write_text(json.dumps(body))
    return str(folder)


def _vehicles(*positions):
    return {"bustime-response": {"vehicle": [
        {"vid": str(i), "tmstmp": "20240601 11:59:00", "lat": str(lat), "lon": "-87.6", "hdg": "10", "rt": "66", "dly": i == 0}
        for i, lat in enumerate(positions)
    ]}}


def _trains(*lats):
    return {"ctatt": {"route": [{"@name": "red", "train": [
        {"rn": str(i), "prdt": "2024-06-01T11:59:00", "lat": str(lat), "lon": "-87.6", "heading": "5", "isApp": "0", "isDly": "1"}
        for i, lat in enumerate(lats)
    ]}]}}


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    store = TableStore(spark, str(tmp_path_factory.mktemp("bronze")))
    jobs.land_bus(spark, _poll(folder / "b1", _vehicles(41.9, 41.8, 0.0)), store, AT - dt.timedelta(minutes=2))
    jobs.land_bus(spark, _poll(folder / "b2", _vehicles(41.9, 41.8)), store, AT + dt.timedelta(days=1))
    assert jobs.land_trains(spark, _poll(folder / "t1", _trains(41.9, 42.0, 41.7, 41.6, 0)), store, AT) == 5
    timetable = raw_files.timetable(spark, DATA)
    tables = {name: jobs.gtfs_static.scan_table(spark, timetable, name, raw_files.loaded_at()) for name in jobs.STATIC_TABLES}
    jobs.gtfs_static.land_static(spark, store, "cta", tables, AT.date())
    assert jobs.land_congestion(spark, raw_files.open_data_pages(spark, DATA), store, AT) == 6000
    assert jobs.land_traffic_counts(spark, raw_files.open_data_pages(spark, DATA), store, AT) == 6000
    first, last = dt.date(2024, 1, 1), dt.date(2024, 2, 9)
    for _ in range(2):
        assert jobs.land_weather(spark, raw_files.weather_responses(spark, DATA), store, first, last, AT) == 40
    return store


def test_build_and_export(spark, bronze, tmp_path, rows):
    lake = TableStore(spark, str(tmp_path / "lake"))
    tables, counts = jobs.build(spark, bronze, lake)
    assert rows(tables["silver_vehicle_positions"], "mode", "vehicle_id") == [
        ("bus", "0"), ("bus", "1"), ("train", "0"), ("train", "1"), ("train", "2"), ("train", "3")]
    assert rows(tables["mart_otp_by_route"], "mode", "route_id", "total_reports", "on_time_rate") == [
        ("bus", "66", 2, 0.5), ("train", "red", 4, 0.0)]
    assert counts["silver_weather"] == 40 and counts["silver_stop_times"] == 6000
    assert lake.read("load_metrics").count() == len(counts)
    assert lake.read("check_results").count() == 91
    declared = len(ASSERTIONS) + len(SUITES["silver_congestion"]) + len(SUITES["silver_weather"])
    assert lake.read("declared_checks").count() == declared
    exported = sinks.export_marts(jobs.open_lake(lake), TableStore(spark, str(tmp_path / "out")))
    assert exported["fleet_latest"] == 6 and sorted(exported) == sorted(p.name for p in (tmp_path / "out").iterdir())
    for name in exported:
        assert len(list((tmp_path / "out" / name).glob("part-*.parquet"))) == 1


def test_bad_newest_poll_blocks_the_build(spark, bronze, tmp_path):
    """Six polls of one day, only the last of them bad; a poll loaded again replaces itself."""
    folder, store = tmp_path / "raw", TableStore(spark, str(tmp_path / "bronze"))
    for i in range(5):
        jobs.land_bus(spark, _poll(folder / f"b{i}", _vehicles(41.9)), store, AT + dt.timedelta(minutes=2 * i))
    jobs.land_trains(spark, _poll(folder / "t1", _trains(41.9, 42.0, 41.7, 41.6, 0)), store, AT)
    jobs.gate_landed(spark, store)
    jobs.land_bus(spark, _poll(folder / "b5", _vehicles(41.9, 0.0)), store, AT + dt.timedelta(minutes=10))
    with pytest.raises(quality.BlockedLoad, match="bronze_vehicle_positions"):
        jobs.gate_landed(spark, store)
    jobs.land_bus(spark, _poll(folder / "b6", _vehicles(41.9, 41.8)), store, AT + dt.timedelta(minutes=10))
    jobs.gate_landed(spark, store)
    assert store.read(jobs.BUS).count() == 7


def test_failed_gate_keeps_dependants_from_being_written(spark, bronze, tmp_path):
    def refuse(name, table):
        if name == "silver_vehicle_positions":
            raise quality.BlockedLoad(name)

    with pytest.raises(quality.BlockedLoad):
        lakehouse.build(spark, jobs.open_bronze(spark, bronze), TableStore(spark, str(tmp_path)), gate=refuse)
    assert (tmp_path / "silver_vehicle_positions").exists() and not (tmp_path / "fact_vehicle_position").exists()


def test_live_tables(spark, bronze, tmp_path, rows):
    live = TableStore(spark, str(tmp_path))
    jobs.stream_fleet(spark, bronze, live, cadence=None)
    assert rows(states.fleet(live), "vehicle_id") == [("0",), ("1",)]
    assert (live.read("accepted").count(), live.read("quarantine").count()) == (4, 1)
    assert live.read("checks").agg(F.count("*")).first()[0] == 7


def test_landing_from_the_command_line_records_its_load(spark, tmp_path, rows):
    root = str(tmp_path / "bronze")
    for minute in ("00", "02"):
        source = _poll(tmp_path / f"b{minute}", _vehicles(41.9, 41.8))
        jobs.main(["land", "--feed", "bus", "--source", source, "--at", f"2024-06-01T12:{minute}:00", "--bronze", root])
    store = TableStore(spark, root)
    assert store.read(jobs.BUS).count() == 4
    assert rows(store.read("load_metrics"), "feed", "row_count") == [("bus", 2), ("bus", 2)]


def test_a_failed_rebuild_leaves_the_last_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.rebuild("t", spark.range(5)) == 5
    with pytest.raises(Exception, match="lost"):
        store.rebuild("t", spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id")))
    assert store.read("t").count() == 5
    assert store.rebuild("t", store.read("t").where("id > 2")) == 2
    assert store.read("t").count() == 2


def test_readers_of_a_versioned_table_always_find_a_whole_one(spark, tmp_path, monkeypatch):
    from wayside import storage

    store = storage.VersionedStore(spark, str(tmp_path))
    for n in (3, 5):
        assert store.rebuild("t", spark.range(n)) == n and store.read("t").count() == n
    opened, real = store.read("t"), storage.write_bytes

    def lost(*args):
        # The new version is written, but the job is lost before it counts.
        assert store.read("t").count() == 5
        raise OSError("lost")

    monkeypatch.setattr(storage, "write_bytes", lost)
    with pytest.raises(OSError, match="lost"):
        store.rebuild("t", spark.range(9))
    assert store.read("t").count() == 5
    monkeypatch.setattr(storage, "write_bytes", real)
    store.rebuild("t", spark.range(7).withColumn("dt", F.col("id") % 2), ["dt"])
    assert opened.count() == 5 and store.read("t").count() == 7
    store.reload_days("t", spark.range(1).withColumn("dt", F.lit(0).cast("long")), ["dt"])
    assert store.read("t").count() == 4 and store.exists("t")
    assert len(list((tmp_path / "t" / "_versions").glob("0*"))) == 2
