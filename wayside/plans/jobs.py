"""The jobs a lake runs: land a feed, build the tables, export, backfill, stream.

    spark-submit wayside/plans/jobs.py build --bronze s3://lake/bronze --lake s3://lake/tables
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.functions.boxes import in_box
from wayside.operators import quality, sinks
from wayside.operators.silver import bus_reports
from wayside.plans import lakehouse
from wayside.plans.rules import ASSERTIONS, BLOCKING_SUITES, SUITES, TABLE_RULES
from wayside.schemas import BRONZE
from wayside.session import cluster_session
from wayside.sources import bus_feed, gtfs_rt, gtfs_static, landing, open_data, train_feed, weather
from wayside.storage import TableStore, VersionedStore, make_folder
from wayside.streaming import feeds, positions, states

# Folders of the landed feeds, and the suite each newest poll must pass.
BUS = "cta/gtfs_rt/vehicle_positions"
TRAIN = "cta/train_tracker/positions"
TRAIN_FEEDS = "cta/gtfs_rt/train_positions_pb"  # chunks of feed messages by day and poll
STATIC = "cta/gtfs_static"
CONGESTION = "socrata/congestion"
TRAFFIC_COUNTS = "socrata/adt"
WEATHER = "open_meteo/weather_daily"
STATIC_TABLES = ["routes", "stops", "trips", "stop_times"]
WEATHER_DDL = ", ".join(f"{m} double" for m in weather.MEASURES) + ", date date, _ingested_at timestamp_ntz"


def _stamp(at: dt.datetime) -> Column:
    return F.lit(at).cast("timestamp_ntz")


# --- landing ---------------------------------------------------------------------


def land_bus(spark: SparkSession, responses: str, bronze: TableStore, at: dt.datetime) -> int:
    """Write one poll's vehicles under its day and time; the same poll again replaces its earlier load."""
    rows = bus_feed.conform(bus_feed.read_responses(spark, responses), _stamp(at))
    return bronze.rebuild(f"{BUS}/dt={at:%Y-%m-%d}/poll={at:%Y%m%dT%H%M%S}", rows)


def land_trains(spark: SparkSession, responses: str, bronze: TableStore, at: dt.datetime) -> int:
    """Write one poll's trains, and the same poll as chunks of its feed."""
    rows = train_feed.conform(train_feed.flatten(train_feed.read_responses(spark, responses), _stamp(at)))
    poll = f"{TRAIN}/dt={at:%Y-%m-%d}/trains_{at:%Y%m%dT%H%M%S}.parquet"
    count = bronze.rebuild(poll, rows)
    landed = bronze.read(poll, rows.schema).withColumn("feed_ts", _stamp(at))
    this_poll = spark.range(1).select(_stamp(at).alias("feed_ts"))
    gtfs_rt.land_feeds(bronze, TRAIN_FEEDS, gtfs_rt.encode(landed, this_poll))
    return count


def land_static(spark: SparkSession, folder: str, bronze: TableStore, day: dt.date, at: dt.datetime) -> DataFrame:
    """Land a timetable set, zipped or unpacked, as the day's snapshot."""
    if folder.endswith(".zip"):
        tables = gtfs_static.scan_zip(spark, folder, _stamp(at))
    else:
        names = gtfs_static.members(spark, folder)
        tables = {name: gtfs_static.scan_table(spark, folder, name, _stamp(at)) for name in names}
    return gtfs_static.land_static(spark, bronze, "cta", tables, day)


def land_congestion(spark: SparkSession, pages: str, bronze: TableStore, at: dt.datetime) -> int:
    records = open_data.scan_congestion(spark, pages, _stamp(at))
    return open_data.land_pages(open_data.congestion_slice(records), bronze.path(CONGESTION))


def land_traffic_counts(spark: SparkSession, pages: str, bronze: TableStore, at: dt.datetime) -> int:
    return bronze.rebuild(TRAFFIC_COUNTS, open_data.scan_found(spark, pages, _stamp(at)))


def land_weather(
    spark: SparkSession, responses: str, bronze: TableStore, first: dt.date, last: dt.date, at: dt.datetime
) -> int:
    """Land a range of days; the same range again replaces its earlier load."""
    days = weather.conform(weather.read_responses(spark, responses), _stamp(at))
    days = weather.within(days, first.isoformat(), last.isoformat())
    return bronze.rebuild(f"{WEATHER}/load={first:%Y%m%d}_{last:%Y%m%d}", days)


def land(spark: SparkSession, feed: str, source: str, bronze: TableStore, at: dt.datetime, days: list[dt.date]) -> DataFrame:
    """Land one feed and record its load: feed, rows, time; a timetable set gives a row for each table."""
    if feed == "static":
        loads = [(f"static/{r['table_name']}", r["row_count"]) for r in land_static(spark, source, bronze, at.date(), at).collect()]
    elif feed == "weather":
        loads = [(feed, land_weather(spark, source, bronze, *days, at))]
    else:
        loads = [(feed, LANDINGS[feed](spark, source, bronze, at))]
    metrics = spark.createDataFrame(loads, "feed string, row_count bigint").withColumn("loaded_at", _stamp(at))
    bronze.append("load_metrics", metrics.withColumn("dt", F.lit(at.date())))
    return metrics


LANDINGS = {"bus": land_bus, "trains": land_trains, "congestion": land_congestion, "traffic_counts": land_traffic_counts}


# --- building --------------------------------------------------------------------


def open_bronze(spark: SparkSession, bronze: TableStore) -> dict[str, DataFrame]:
    """Everything landed, as the table graph wants it."""
    static = {name: landing.newest_snapshot(spark, bronze.path(f"{STATIC}/{name}")) for name in STATIC_TABLES}
    return {
        **static,
        "bus_positions": landing.typed_scan(spark, bronze.path(BUS), BRONZE["bus_positions"]).drop("dt", "poll"),
        "decoded_trains": gtfs_rt.decode(gtfs_rt.read_chunks(spark, bronze.path(TRAIN_FEEDS))),
        "congestion": landing.typed_scan(
            spark, bronze.path(CONGESTION), BRONZE["congestion"] + ", _ingested_at timestamp_ntz"
        ),
        "weather": landing.typed_scan(spark, bronze.path(WEATHER), WEATHER_DDL).drop("load"),
    }


def gate_landed(spark: SparkSession, bronze: TableStore) -> None:
    """The newest poll of each live feed must pass its suite before anything is built."""
    roots = {"bronze_vehicle_positions": (BUS, "bus_positions"), "bronze_train_positions": (TRAIN, "train_positions")}
    for suite in BLOCKING_SUITES:
        root, table = roots[suite]
        newest = landing.newest_poll(spark, bronze.path(root), BRONZE[table])
        quality.enforce(quality.evaluate(suite, newest, SUITES[suite]), suite, "success")


def check_table(name: str, table: DataFrame) -> list[tuple[str, str, str | None, bool]]:
    """All declared assertions and suites of a table just written, as result rows.

    A failed blocking assertion is raised, so that the table's readers are not built.
    """
    rows = []
    for assertion in (a for a in ASSERTIONS if a.table == name):
        results = assertion.run(name, table)
        (found,) = results.collect()
        rows.append((name, assertion.name, None, bool(found["passed"])))
        if assertion.blocking and not found["passed"]:
            raise quality.BlockedLoad(f"{assertion.name}: {found.asDict()}")
    if name in SUITES:
        rows += [(name, r["expectation"], r["column_name"], bool(r["success"])) for r in quality.evaluate(name, table, SUITES[name]).collect()]
    return rows


def build(spark: SparkSession, bronze: TableStore, lake: TableStore) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Gate the feeds, write the lake, and record loads and check results as tables.

    Assertions and suites run as soon as their table is written (`declared_checks`), the
    table rules once all are (`check_results`).
    """
    gate_landed(spark, bronze)
    checked: list[tuple] = []
    tables, rows = lakehouse.build(
        spark, open_bronze(spark, bronze), lake, gate=lambda name, table: checked.extend(check_table(name, table))
    )
    lake.rebuild("load_metrics", sinks.load_metrics(spark, rows, lake))
    ddl = "table_name string, check_name string, column_name string, passed boolean"
    lake.rebuild("declared_checks", spark.createDataFrame(sorted(checked, key=str), ddl))
    lake.rebuild("check_results", quality.run_checks(spark, TABLE_RULES, tables))
    return tables, rows


def open_lake(lake: TableStore) -> dict[str, DataFrame]:
    return {name: lake.read(name) for name, model in lakehouse.MODELS.items() if model.stored}


# --- streaming -------------------------------------------------------------------


def stream_fleet(spark: SparkSession, bronze: TableStore, live: TableStore, cadence: str | None = feeds.CADENCE) -> None:
    """Gate the bus feed, and log the newest accepted report per vehicle (`states.fleet` reads it).

    At a cadence both run for ever side by side. Without one the gate works on what has
    landed, and then the fleet on what it accepted.
    """
    suite = "bronze_vehicle_positions"
    make_folder(spark, live.path("accepted"))

    def reports(root: str, folders: list[str]) -> DataFrame:
        return positions.positions_stream(spark, root, BRONZE["bus_positions"]).drop(*folders)

    def gate():
        handle = positions.gated(live, suite, SUITES[suite])
        return positions.start(reports(bronze.path(BUS), ["dt", "poll"]), handle, live.path("progress/gate"), cadence)

    def fleet():
        found = bus_reports(reports(live.path("accepted"), ["batch"])).where(in_box("lat", "lon"))
        changes = states.fleet_changes(found, states.LASTS if cadence else None)
        progress = live.path("progress/fleet" if cadence else "progress/fleet-once")
        return positions.start(changes, states.log_to(live, "fleet_log"), progress, cadence, "update")

    if cadence:
        feeds.run_feeds({"gate": gate, "fleet": fleet}, lasting=True)
    else:
        feeds.run_feeds({"gate": gate})
        feeds.run_feeds({"fleet": fleet})


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["land", "build", "export", "export_feeds", "backfill", "stream"])
    parser.add_argument("--feed", choices=["static", "weather", *LANDINGS], help="what to land")
    parser.add_argument("--source", help="folder of the landed response files")
    parser.add_argument("--at", type=dt.datetime.fromisoformat, help="time of the poll or load, now if left out")
    parser.add_argument("--days", nargs=2, type=dt.date.fromisoformat, default=[], help="first and last day of a weather load or of exported feeds; a backfill looks from the first on")
    parser.add_argument("--bronze", help="root of the landed feeds")
    parser.add_argument("--lake", help="root of the built tables")
    parser.add_argument("--out", help="root of the exported files or of the live tables")
    args = parser.parse_args(argv)
    spark = cluster_session(f"wayside-{args.job}")
    # Landed feeds and exports are folders that others read by their path; tables of the lake are read through the store.
    kinds = {"bronze": TableStore, "lake": VersionedStore, "out": TableStore}
    store = {name: kind(spark, getattr(args, name)) for name, kind in kinds.items() if getattr(args, name)}
    if args.job == "land":
        land(spark, args.feed, args.source, store["bronze"], args.at or dt.datetime.now().replace(microsecond=0), args.days).show(truncate=False)
    elif args.job == "build":
        build(spark, store["bronze"], store["lake"])
    elif args.job == "export":
        sinks.export_marts(open_lake(store["lake"]), store["out"])
    elif args.job == "export_feeds":
        chunks = gtfs_rt.read_chunks(spark, store["bronze"].path(TRAIN_FEEDS))
        if args.days:
            chunks = chunks.where(F.col("dt").between(*args.days))
        gtfs_rt.write_feeds(chunks, args.out).agg(F.sum("entities")).collect()
    elif args.job == "backfill":
        polls, root = store["bronze"].path(TRAIN), store["bronze"].path(TRAIN_FEEDS)
        gtfs_rt.land_feeds(store["bronze"], TRAIN_FEEDS, gtfs_rt.backfill(spark, polls, root, *args.days[:1]))
    else:
        stream_fleet(spark, store["bronze"], store["out"])


if __name__ == "__main__":
    main()
