"""Publishing marts: named Parquet exports, catalog snapshots, load metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wayside.operators.serving import EXPORTED_HOTSPOTS, fleet_latest, hotspots
from wayside.storage import TableStore, counted

Tables = Mapping[str, DataFrame]


def _whole(name: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: tables[name]


# Names of the published files.
EXPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "pipeline_freshness": _whole("mart_pipeline_freshness"),
    "otp_by_route": _whole("mart_otp_by_route"),
    "otp_by_mode_hour": _whole("mart_otp_by_mode_hour"),
    "congestion_hotspots": lambda tables: hotspots(tables["mart_congestion_hotspots"], EXPORTED_HOTSPOTS),
    "congestion_by_hour": _whole("mart_congestion_by_hour"),
    "delay_vs_weather": _whole("mart_delay_vs_weather"),
    "delay_vs_congestion": _whole("mart_delay_vs_congestion"),
    "fleet_latest": lambda tables: fleet_latest(tables["fact_vehicle_position"]),
}


def load_metrics(spark: SparkSession, rows: Mapping[str, int], store: TableStore) -> DataFrame:
    """One row per written table: name, rows counted while writing, path."""
    return spark.createDataFrame(
        [(name, count, store.path(name)) for name, count in rows.items()],
        "table_name string, row_count bigint, path string",
    )


def export_marts(tables: Tables, store: TableStore) -> dict[str, int]:
    """Write every published result; small ones come out as a single file."""
    return {name: store.rebuild(name, make(tables)) for name, make in EXPORTS.items()}


def snapshot_tables(spark: SparkSession, source: str, target: str, prefix: str = "") -> dict[str, int]:
    """Copy every table of one catalog database into another, replacing old copies."""
    copied = {}
    for table in sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary):
        if table.startswith(prefix):
            frame, seen = counted(spark.table(f"`{source}`.`{table}`"))
            frame.write.mode("overwrite").saveAsTable(f"`{target}`.`{table}`")
            copied[table] = seen.get["rows"]
    return copied
