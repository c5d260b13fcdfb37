"""Sinks: what was written is read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from registry import query
from registry.inputs import Landed, built
from registry.parts import compose
from wayside.operators import sinks
from wayside.storage import TableStore, VersionedStore, fresh_folder

_EXPORTED = {
    "pipeline_freshness": "x_freshness",
    "otp_by_route": "x_otp_route",
    "otp_by_mode_hour": "x_otp_mode_hour",
    "congestion_hotspots": "(SELECT * FROM x_hotspots LIMIT 200)",
    "congestion_by_hour": "x_road_by_hour",
    "delay_vs_weather": "x_delay_weather",
    "delay_vs_congestion": "x_delay_congestion",
    "fleet_latest": "(SELECT DISTINCT mode, vehicle_id FROM x_fact_position)",
}

_READ = [
    "mart_pipeline_freshness", "mart_otp_by_route", "mart_otp_by_mode_hour", "mart_congestion_hotspots", "mart_congestion_by_hour",
    "mart_delay_vs_weather", "mart_delay_vs_congestion", "fact_vehicle_position",
]


def _counts(names) -> str:
    return compose("\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, 0::BIGINT AS differing FROM {piece}" for name, piece in names.items()
    ))


def _differing(written, meant):
    """Rows of either side that the other lacks."""
    meant = meant.select(written.columns)
    lacking = written.exceptAll(meant).unionByName(meant.exceptAll(written))
    return lacking.agg(F.count(F.lit(1)).alias("differing"))


@query("snk_01_parquet_export", _counts(_EXPORTED))
def exports(spark, sf_dir):
    tables, _, _ = built(spark, sf_dir, *_READ)
    store = TableStore(spark, fresh_folder(spark, "exports"))
    rows = sinks.export_marts(tables, store)
    checked = [
        _differing(store.read(name), make(tables)).select(F.lit(name).alias("table_name"), "differing")
        for name, make in sinks.EXPORTS.items()
    ]
    return sinks.load_metrics(spark, rows, store).drop("path").join(reduce(DataFrame.unionByName, checked), "table_name")


_COPIED = {"mart_otp_by_route": "x_otp_route", "mart_segment_speed_profile": "x_speed_profile"}


@query("snk_02_snapshot_export", _counts(_COPIED))
def snapshot(spark, sf_dir):
    """Marts saved as catalog tables, copied into a second database, counted there."""
    tables, _, _ = built(spark, sf_dir, *_COPIED)
    folder = fresh_folder(spark, "catalog")
    live, copy = (f"{kind}_{folder[-12:]}" for kind in ("live", "copy"))
    for database in (live, copy):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/{database}'")
    for name in _COPIED:
        tables[name].write.saveAsTable(f"{live}.{name}")
    copied = sinks.snapshot_tables(spark, live, copy)
    checked = [
        _differing(spark.table(f"{copy}.{name}"), tables[name]).select(
            F.lit(name).alias("table_name"), F.lit(rows).cast("bigint").alias("row_count"), "differing"
        )
        for name, rows in copied.items()
    ]
    return reduce(DataFrame.unionByName, checked)


@query("snk_03_table_rebuild", compose("SELECT * FROM x_bus WHERE dly"))
def rebuilt(spark, sf_dir):
    """The second build replaces the first."""
    store = TableStore(spark, fresh_folder(spark, "rebuild"))
    bus = Landed(spark, sf_dir)["bus_positions"]
    store.rebuild("bus", bus)
    store.rebuild("bus", bus.where("dly"))
    return store.read("bus")


@query("snk_03_versioned_rebuild", compose("""
SELECT 'before' AS seen, count(*) AS reports FROM x_bus UNION ALL SELECT 'after', count(*) FROM x_bus WHERE dly
"""))
def rebuilt_by_version(spark, sf_dir):
    """A reader that opened the table before the second build still finds all of the first."""
    store = VersionedStore(spark, fresh_folder(spark, "versions"))
    bus = Landed(spark, sf_dir)["bus_positions"]
    store.rebuild("bus", bus)
    before = store.read("bus")
    store.rebuild("bus", bus.where("dly"))
    seen = {"before": before, "after": store.read("bus")}
    counts = [f.agg(F.count(F.lit(1)).alias("reports")).select(F.lit(name).alias("seen"), "reports") for name, f in seen.items()]
    return counts[0].unionByName(counts[1])


@query("snk_04_dated_append", compose("SELECT *, _ingested_at::DATE AS dt FROM x_bus"))
def appended(spark, sf_dir):
    """Two loads of the same days add up."""
    store = TableStore(spark, fresh_folder(spark, "append"))
    bus = Landed(spark, sf_dir)["bus_positions"].withColumn("dt", F.to_date("_ingested_at"))
    store.append("bus", bus.where("dly"))
    store.append("bus", bus.where("not dly"))
    return store.read("bus")
