"""Streams over landed files, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import query, raw_files
from registry.inputs import model
from registry.parts import IN_BOX, compose, pick
from wayside.functions.boxes import in_box
from wayside.functions.picking import keep_first
from wayside.operators.silver import bus_reports
from wayside.plans.rules import SUITES
from wayside.schemas import BRONZE
from wayside.storage import TableStore, fresh_folder
from wayside.streaming import feeds, positions, states

# Longer than the data, so the watermark drops nothing and batch results must be met.
WHOLE_SPAN = "60 days"
_FILES = 10


def _bus_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = raw_files.bus_days(spark, sf_dir)
    return positions.positions_stream(spark, root, BRONZE["bus_positions"], files_per_batch=_FILES)


def _run(spark, stream, handle, mode="append") -> None:
    positions.start(stream, handle, fresh_folder(spark, "progress"), mode=mode).awaitTermination()


def _store(spark) -> TableStore:
    return TableStore(spark, fresh_folder(spark, "stream"))


@query("str_01_positions_stream", compose("SELECT *, _ingested_at::DATE AS dt FROM x_bus"))
def landed_reports(spark, sf_dir):
    store = _store(spark)
    _run(spark, _bus_stream(spark, sf_dir), positions.append_to(store, "bus"))
    return store.read("bus").drop("batch")


_BUS_REPORTS = f"""
SELECT 'CTA' AS agency, 'bus' AS mode, vid AS vehicle_id, rt AS route_id, des AS headsign, lat, lon,
       hdg AS heading, dly AS is_delayed, tmstmp AS report_ts, _ingested_at
FROM x_bus WHERE {IN_BOX}
"""


def _reports(spark, sf_dir) -> DataFrame:
    return bus_reports(_bus_stream(spark, sf_dir)).where(in_box("lat", "lon"))


@query("str_02_stream_dedupe", compose(f"SELECT DISTINCT mode, vehicle_id, report_ts FROM ({_BUS_REPORTS})"))
def first_reports(spark, sf_dir):
    store = _store(spark)
    _run(spark, positions.first_reports(_reports(spark, sf_dir), WHOLE_SPAN), positions.append_to(store, "bus"))
    return store.read("bus").select("mode", "vehicle_id", "report_ts")


_FIRST = pick(f"({_BUS_REPORTS})", "mode, vehicle_id, report_ts", "_ingested_at, route_id, headsign, lat, lon")


_HOURLY = f"""
SELECT p.agency, p.mode, p.route_id, ifnull(r.route_long_name, p.route_id) AS route_name, p.report_ts::DATE AS report_date,
       hour(p.report_ts)::INTEGER AS report_hour, count(*) AS report_count,
       count(*) FILTER (WHERE p.is_delayed) AS delayed_count, count(DISTINCT p.vehicle_id) AS active_vehicles
FROM ({_FIRST}) p LEFT JOIN x_stg_routes r ON r.route_id = p.route_id GROUP BY ALL
"""


@query("str_03_hourly_delay_exact", compose(_HOURLY))
def hourly_exact(spark, sf_dir):
    store = _store(spark)
    routes = model(spark, sf_dir, "stg_routes")
    _run(spark, _reports(spark, sf_dir), positions.hourly_delay_exact(store, routes, positions.BY_DAY))
    return store.read("hourly").drop("delayed_rate")


@query("str_03_hourly_delay_estimate", compose(f"""
SELECT date_trunc('hour', report_ts) AS hour_start, mode, route_id, count(*) AS report_count,
       count(*) FILTER (WHERE is_delayed) AS delayed_count
FROM ({_BUS_REPORTS}) GROUP BY ALL
"""))
def hourly_estimate(spark, sf_dir):
    """Counts are exact; the vehicle estimate is left out of the comparison."""
    store = _store(spark)
    hours = positions.hourly_delay_estimate(_reports(spark, sf_dir), WHOLE_SPAN)
    _run(spark, hours, positions.append_to(store, "hours"), mode="update")
    keys = ["hour_start", "mode", "route_id"]
    last = keep_first(store.read("hours"), keys, by=["batch"], descending=["batch"])
    return last.drop("batch", "active_vehicles")


_NEWEST = pick(f"({_BUS_REPORTS})", "mode, vehicle_id", "report_ts DESC, _ingested_at, route_id, headsign, lat, lon")


@query("str_04_latest_fleet", compose(_NEWEST))
def live_fleet(spark, sf_dir):
    store = _store(spark)
    _run(spark, _reports(spark, sf_dir), positions.latest_fleet(store))
    return positions.fleet(store)


@query("str_02_stream_earliest", compose(_FIRST))
def earliest_reports(spark, sf_dir):
    """The first ingested report of every key with its payload, whatever the files' order."""
    store = _store(spark)
    changes = states.earliest_changes(_reports(spark, sf_dir)).withColumn("report_date", F.to_date("report_ts"))
    _run(spark, changes, states.log_to(store, "reports_log", "report_date"), mode="update")
    return states.earliest(store)


@query("str_03_hourly_delay_bitmaps", compose(_HOURLY))
def hourly_merged(spark, sf_dir):
    """Each batch adds its bitmaps of vehicles; no report is read twice."""
    store = _store(spark)
    _run(spark, states.earliest_changes(_reports(spark, sf_dir)), states.hourly_bitmaps(store), mode="update")
    return states.hourly(store, model(spark, sf_dir, "stg_routes")).drop("delayed_rate")


@query("str_04_fleet_state", compose(_NEWEST))
def fleet_by_state(spark, sf_dir):
    """Only changed vehicles are written; the log is compacted before it is read."""
    store = _store(spark)
    _run(spark, states.fleet_changes(_reports(spark, sf_dir)), states.log_to(store, "fleet_log"), mode="update")
    states.compact_fleet(store)
    return states.fleet(store)


@query("str_05_stream_gate", compose(f"""
SELECT vid, tmstmp, lat, lon, _ingested_at, CASE WHEN {IN_BOX} THEN 'accepted' ELSE 'quarantine' END AS lane FROM x_bus
"""))
def gated_reports(spark, sf_dir):
    store = _store(spark)
    suite = "bronze_vehicle_positions"
    _run(spark, _bus_stream(spark, sf_dir), positions.gated(store, suite, SUITES[suite]))
    lanes = [store.read(lane).withColumn("lane", F.lit(lane)) for lane in ("accepted", "quarantine")]
    return lanes[0].unionByName(lanes[1]).select("vid", "tmstmp", "lat", "lon", "_ingested_at", "lane")


@query("str_06_two_feeds", compose("""
SELECT 'bus' AS feed, count(*) AS reports FROM x_bus UNION ALL SELECT 'train', count(*) FROM x_decoded
"""))
def two_feeds(spark, sf_dir):
    """The rail feed loses its first cycle; it starts again and the bus feed never stops."""
    store = _store(spark)
    train_root = raw_files.train_polls(spark, sf_dir)
    trains = positions.positions_stream(spark, train_root, BRONZE["train_positions"], files_per_batch=_FILES)
    land_train, lost = positions.append_to(store, "train"), []

    def lossy(batch, batch_id):
        if not lost:
            lost.append(batch_id)
            raise RuntimeError("lost cycle")
        land_train(batch, batch_id)

    progress = {name: fresh_folder(spark, name) for name in ("bus", "train")}
    feeds.run_feeds({
        "bus": lambda: positions.start(
            _bus_stream(spark, sf_dir), positions.append_to(store, "bus"), progress["bus"]
        ),
        "train": lambda: positions.start(trains, lossy, progress["train"]),
    }, lasting=True, delay=0.1)
    counts = [
        store.read(name).agg(F.count(F.lit(1)).alias("reports")).select(F.lit(name).alias("feed"), "reports")
        for name in progress
    ]
    return counts[0].unionByName(counts[1])
