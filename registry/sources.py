"""Sources over response files derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry import query, raw_files

from registry.parts import IN_BOX, compose
from wayside.operators import silver
from wayside.schemas import BRONZE
from wayside.sources import bus_feed, gtfs_rt, gtfs_static, landing, open_data, train_feed, weather
from wayside.storage import TableStore, fresh_folder, settle

_AT = f"TIMESTAMP '{raw_files.LOADED_AT}' AS _ingested_at"


def _timetable(spark, sf_dir, name):
    return gtfs_static.scan_table(spark, raw_files.timetable(spark, sf_dir), name, raw_files.loaded_at())


@query("src_01_gtfs_csv_scan", compose(f"SELECT *, {_AT} FROM x_stop_times"))
def stop_times_text(spark, sf_dir):
    return _timetable(spark, sf_dir, "stop_times")


@query("src_01_gtfs_zip_scan", compose(f"SELECT *, {_AT} FROM x_stop_times"))
def zipped_stop_times(spark, sf_dir):
    """Stop times in zip archives, unpacked by a task for each member."""
    return gtfs_static.scan_zip(spark, raw_files.zipped_stop_times(spark, sf_dir), raw_files.loaded_at())["stop_times"]


@query("src_01_gtfs_csv_scan_stops", compose(f"""
SELECT * REPLACE (nullif(stop_lat, '') AS stop_lat, nullif(location_type, '') AS location_type), {_AT} FROM x_stops
"""))
def stops_text(spark, sf_dir):
    return _timetable(spark, sf_dir, "stops")


def _two_snapshots(spark, sf_dir):
    """An older snapshot with half of the trips, then today's, which is loaded twice."""
    store = TableStore(spark, fresh_folder(spark, "snapshots"))
    trips = _timetable(spark, sf_dir, "trips")
    half = {"trips": trips.where("direction_id = '0'")}
    gtfs_static.land_static(spark, store, "cta", half, dt.date(2026, 6, 1))
    tables = {"trips": trips, "routes": _timetable(spark, sf_dir, "routes")}
    gtfs_static.land_static(spark, store, "cta", tables, dt.date(2026, 6, 2))
    metrics = gtfs_static.land_static(spark, store, "cta", tables, dt.date(2026, 6, 2))
    return store, metrics


@query("src_02_latest_snapshot", compose(f"SELECT *, {_AT} FROM x_trips"))
def newest_trips(spark, sf_dir):
    store, _ = _two_snapshots(spark, sf_dir)
    return landing.newest_snapshot(spark, store.path("cta/gtfs_static/trips"))


@query("snk_05_load_metrics", compose("""
SELECT 'routes' AS table_name, count(*) AS row_count FROM x_routes UNION ALL SELECT 'trips', count(*) FROM x_trips
"""))
def landing_metrics(spark, sf_dir):
    _, metrics = _two_snapshots(spark, sf_dir)
    return metrics.drop("path")


@query("snk_06_daily_reload", compose("""
SELECT DATE '2026-06-01' AS dt, count(*) AS row_count FROM x_trips WHERE direction_id = '0'
UNION ALL SELECT DATE '2026-06-02', count(*) FROM x_trips
"""))
def reloaded_days(spark, sf_dir):
    """A second load of the same day replaces it and leaves the other day alone."""
    store, _ = _two_snapshots(spark, sf_dir)
    return store.read("cta/gtfs_static/trips").groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


_BUS_JSON = f"""
SELECT user_id::VARCHAR AS vid, CASE WHEN event_id % 31 > 0 THEN date_trunc('hour', ts) END AS tmstmp,
       CASE WHEN event_id % 97 > 0 THEN 41.0::DOUBLE + (event_id % 203)::DOUBLE / 100 END AS lat,
       -89.0::DOUBLE + (event_id % 207)::DOUBLE / 100 AS lon,
       CASE WHEN event_id % 89 > 0 THEN (event_id % 360)::INTEGER END AS hdg, user_id % 50 AS pid,
       'NATION_' || (user_id % 30) AS rt, event_type AS des, event_id % 5000 AS pdist, event_type = 'error' AS dly,
       CAST(NULL AS VARCHAR) AS tatripid, CAST(NULL AS VARCHAR) AS origtatripno, CAST(NULL AS VARCHAR) AS tablockid,
       CASE WHEN event_id % 3 > 0 THEN 'Z' || (event_id % 3) END AS zone, {_AT}
FROM events WHERE user_id % 4 > 0 AND event_id // 50 % 20 < 19
"""


def _bus(spark, sf_dir):
    responses = bus_feed.read_responses(spark, raw_files.bus_responses(spark, sf_dir))
    return bus_feed.conform(responses, raw_files.loaded_at())


query("src_03_bus_json_conform", _BUS_JSON)(_bus)


@query("src_04_error_batches_skipped", f"SELECT rt, count(*) AS vehicle_rows FROM ({_BUS_JSON}) GROUP BY rt")
def rows_despite_errors(spark, sf_dir):
    return _bus(spark, sf_dir).groupBy("rt").agg(F.count(F.lit(1)).alias("vehicle_rows"))


_LINE = "['red', 'blue', 'brn', 'g', 'org', 'p', 'pink', 'y'][user_id // 4 % 8 + 1]"


def _trains(spark, sf_dir):
    responses = train_feed.read_responses(spark, raw_files.train_responses(spark, sf_dir))
    return train_feed.flatten(responses, raw_files.loaded_at())


@query("src_05_train_json_flatten", f"""
SELECT user_id::VARCHAR AS rn, {_LINE} AS rt, (event_id % 2)::VARCHAR AS "isApp", (event_id % 40)::VARCHAR AS "nextStpId",
       CASE WHEN event_type = 'error' THEN '1' WHEN event_id % 3 > 0 THEN '0' END AS "isDly"
FROM events WHERE user_id % 4 = 0
""")
def train_records(spark, sf_dir):
    return _trains(spark, sf_dir).select("rn", "rt", "isApp", "nextStpId", "isDly")


@query("src_06_train_json_conform", f"""
SELECT user_id::VARCHAR AS rn, {_LINE} AS rt, date_trunc('hour', ts) AS tmstmp,
       41.0::DOUBLE + (event_id % 203)::DOUBLE / 100 AS lat,
       CASE WHEN event_id % 97 > 0 THEN -89.0::DOUBLE + (event_id % 207)::DOUBLE / 100 END AS lon,
       (event_id % 360)::INTEGER AS heading, 'Loop' AS "destNm", CAST(NULL AS VARCHAR) AS "destSt",
       CAST(NULL AS VARCHAR) AS "nextStaId", CAST(NULL AS VARCHAR) AS "nextStaNm",
       (event_id % 40)::VARCHAR AS "nextStpId", CASE WHEN event_id % 11 > 0 THEN date_trunc('second', ts) END AS "arrT",
       event_id % 2 = 1 AS "isApp", event_type = 'error' AS "isDly", CAST(NULL AS VARCHAR) AS "trDr", {_AT}
FROM events WHERE user_id % 4 = 0
""")
def train_positions(spark, sf_dir):
    return train_feed.conform(_trains(spark, sf_dir))


def _feeds(spark, sf_dir, rows=None):
    rows = rows if rows is not None else raw_files.train_rows(spark, sf_dir)
    return gtfs_rt.encode(rows, rows.select("feed_ts").distinct())


@query("src_07_gtfs_rt_decode", compose(f"""
SELECT * REPLACE (lat::FLOAT::DOUBLE AS lat, lon::FLOAT::DOUBLE AS lon) FROM x_decoded WHERE {IN_BOX}
"""))
def decoded_feeds(spark, sf_dir):
    """Reports written as feed files and decoded again; coordinates are 32-bit on the wire."""
    root = fresh_folder(spark, "feeds")
    gtfs_rt.write_feeds(_feeds(spark, sf_dir), root).agg(F.sum("entities")).collect()
    return gtfs_rt.decode(gtfs_rt.read_feeds(spark, root))


_FEED_FILES = f"""
SELECT strftime(report_ts, 'trains_%Y%m%dT000000.pb') AS path, report_ts::DATE AS dt,
       (count(*) FILTER (WHERE {IN_BOX}))::INTEGER AS entities
FROM x_decoded GROUP BY ALL
"""


@query("src_08_gtfs_rt_encode", compose(f"""
SELECT path, dt, entities, '2.0' AS version, 0 AS incrementality, epoch(dt)::BIGINT AS header_at FROM ({_FEED_FILES})
"""))
def encoded_feeds(spark, sf_dir):
    """One file for every poll, each with its own header."""
    root = fresh_folder(spark, "feeds")
    gtfs_rt.write_feeds(_feeds(spark, sf_dir), root).agg(F.sum("entities")).collect()
    files = gtfs_rt.headers(gtfs_rt.read_feeds(spark, root))
    day = F.to_date(F.regexp_extract("path", "dt=([^/]+)/", 1))
    return files.withColumn("dt", day).withColumn("path", F.element_at(F.split("path", "/"), -1))


@query("src_09_protobuf_backfill", compose(f"SELECT path, dt, entities FROM ({_FEED_FILES}) WHERE day(dt) % 2 = 1"))
def backfilled_feeds(spark, sf_dir):
    """Even days already have their feed file; only odd ones are written."""
    polls, root = raw_files.train_polls(spark, sf_dir), fresh_folder(spark, "feeds")
    rows = raw_files.train_rows(spark, sf_dir)
    present = _feeds(spark, sf_dir, rows.where(F.dayofmonth("feed_ts") % 2 == 0))
    gtfs_rt.write_feeds(present, root).agg(F.sum("entities")).collect()
    written = settle(gtfs_rt.write_feeds(gtfs_rt.backfill(spark, polls, root), root), "written")
    name = F.element_at(F.split("path", "/"), -1)
    return written.select(name.alias("path"), F.to_date(F.regexp_extract("path", "dt=([^/]+)/", 1)).alias("dt"), "entities")


def _one_poll(spark, sf_dir):
    """All train reports as a single hot poll."""
    return raw_files.train_rows(spark, sf_dir).withColumn("feed_ts", F.lit(raw_files.LOADED_AT).cast("timestamp_ntz"))


@query("src_07_gtfs_rt_split_decode", compose(f"""
SELECT * REPLACE (lat::FLOAT::DOUBLE AS lat, lon::FLOAT::DOUBLE AS lon) FROM x_decoded WHERE {IN_BOX}
"""))
def decoded_parts(spark, sf_dir):
    """One feed file with every report, read in parts of 16 KB by a task for every 64 KB."""
    root, rows = fresh_folder(spark, "feeds"), _one_poll(spark, sf_dir)
    gtfs_rt.write_feeds(_feeds(spark, sf_dir, rows), root).agg(F.sum("entities")).collect()
    return gtfs_rt.decode(gtfs_rt.read_feeds(spark, root, part=16 << 10), each=64 << 10)


def _landed_chunks(spark, sf_dir, rows=None):
    store = TableStore(spark, fresh_folder(spark, "chunks"))
    gtfs_rt.land_feeds(store, "trains", _feeds(spark, sf_dir, rows))
    return store


@query("src_08_gtfs_rt_chunks", compose(f"""
SELECT path, dt, entities, '2.0' AS version, 0 AS incrementality, epoch(dt)::BIGINT AS header_at FROM ({_FEED_FILES})
"""))
def chunked_feeds(spark, sf_dir):
    """Polls as a table of chunks, landed twice; each has one header, read without its entities."""
    store = _landed_chunks(spark, sf_dir)
    gtfs_rt.land_feeds(store, "trains", _feeds(spark, sf_dir))
    return gtfs_rt.headers(gtfs_rt.read_chunks(spark, store.path("trains")))


@query("src_08_gtfs_rt_decode_chunks", compose(f"""
SELECT * REPLACE (lat::FLOAT::DOUBLE AS lat, lon::FLOAT::DOUBLE AS lon) FROM x_decoded WHERE {IN_BOX}
"""))
def decoded_chunks(spark, sf_dir):
    """One hot poll as chunks, decoded by as many tasks as it has files."""
    store = _landed_chunks(spark, sf_dir, _one_poll(spark, sf_dir))
    return gtfs_rt.decode(gtfs_rt.read_chunks(spark, store.path("trains")))


@query("src_09_chunk_backfill", compose(f"SELECT path, dt, entities FROM ({_FEED_FILES})"))
def backfilled_chunks(spark, sf_dir):
    """Even days have their chunks; the backfill adds the odd ones and finds none the second time."""
    polls, rows = raw_files.train_polls(spark, sf_dir), raw_files.train_rows(spark, sf_dir)
    store = _landed_chunks(spark, sf_dir, rows.where(F.dayofmonth("feed_ts") % 2 == 0))
    for _ in range(2):
        gtfs_rt.land_feeds(store, "trains", gtfs_rt.backfill(spark, polls, store.path("trains")))
    chunks = gtfs_rt.read_chunks(spark, store.path("trains"))
    return chunks.groupBy("path", "dt").agg(F.sum("entities").cast("int").alias("entities"))


_ROAD = compose(f"SELECT * REPLACE (TIMESTAMP '{raw_files.LOADED_AT}' AS _ingested_at) FROM x_congestion")


def _road(spark, sf_dir):
    return open_data.scan_congestion(spark, raw_files.open_data_pages(spark, sf_dir), raw_files.loaded_at())


query("src_10_socrata_json_conform", _ROAD)(_road)


@query("src_11_socrata_where", f"SELECT * FROM ({_ROAD}) WHERE time >= '2018-02-01'")
def road_slice(spark, sf_dir):
    """Oldest first from a start date, landed as pages and read back."""
    path = fresh_folder(spark, "pages")
    open_data.land_pages(open_data.congestion_slice(_road(spark, sf_dir), "2018-02-01"), path)
    return spark.read.parquet(path)


@query("src_12_adt_reference", _ROAD)
def reference_records(spark, sf_dir):
    """The same pages under a declared schema with the nested point: it is gone."""
    ddl = f"{BRONZE['congestion']}, _start_point struct<type: string, coordinates: array<string>>"
    return open_data.scan(spark, raw_files.open_data_pages(spark, sf_dir), raw_files.loaded_at(), ddl)


@query("src_12_undeclared_fields", _ROAD)
def found_records(spark, sf_dir):
    """The same pages without any schema, read once; the nested point is found and dropped."""
    return open_data.scan_found(spark, raw_files.open_data_pages(spark, sf_dir), raw_files.loaded_at())


@query("src_13_weather_columnar_json", compose(f"""
SELECT date, max(COLUMNS(* EXCLUDE (date, _ingested_at))), {_AT} FROM x_weather
WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-02-05' GROUP BY date
"""))
def weather_days(spark, sf_dir):
    responses = weather.read_responses(spark, raw_files.weather_responses(spark, sf_dir))
    return weather.within(weather.conform(responses, raw_files.loaded_at()), "2024-01-03", "2024-02-05")


@query("src_14_parquet_glob_scan", compose("SELECT *, _ingested_at::DATE AS dt FROM x_bus"))
def all_bus_days(spark, sf_dir):
    return landing.typed_scan(spark, raw_files.bus_days(spark, sf_dir), BRONZE["bus_positions"])


@query("src_15_latest_file_scan", compose("""
SELECT * FROM x_bus WHERE date_trunc('hour', _ingested_at) = (SELECT date_trunc('hour', max(_ingested_at)) FROM x_bus)
"""))
def newest_bus_poll(spark, sf_dir):
    """Hourly polls in folders of their own, each of several files: all of the last one's."""
    return landing.newest_poll(spark, raw_files.bus_polls(spark, sf_dir), BRONZE["bus_positions"])


@query("slv_05_train_positions_from_feeds", compose(f"""
SELECT count(*) AS rows, count(DISTINCT vehicle_id) AS vehicles, min(report_ts) AS first_ts, max(report_ts) AS last_ts
FROM (SELECT DISTINCT vehicle_id, report_ts FROM x_decoded WHERE {IN_BOX})
"""))
def trains_from_feeds(spark, sf_dir):
    """Feed bytes to conformed trains without landing them in between."""
    trains = silver.train_positions(gtfs_rt.decode(_feeds(spark, sf_dir)))
    return trains.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("vehicle_id").alias("vehicles"),
        F.min("report_ts").alias("first_ts"),
        F.max("report_ts").alias("last_ts"),
    )
