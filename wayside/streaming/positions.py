"""The live position feed as streams.

Every sink writes under the micro-batch's number and replaces it on a rerun, so a
batch repeated after a failure leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wayside.functions.picking import keep_first
from wayside.operators import quality
from wayside.operators.intermediate import delay_by_route_hour, delayed, vehicle_hours
from wayside.operators.silver import earliest_reports
from wayside.operators.staging import vehicle_positions
from wayside.schemas import SILVER, struct
from wayside.storage import TableStore

Batch = Callable[[DataFrame, int], None]


def positions_stream(
    spark: SparkSession,
    root: str,
    ddl: str = SILVER["silver_vehicle_positions"],
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files appended below a root, in any `dt=` folder."""
    reader = spark.readStream.schema(struct(ddl))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(root)


def _timed(reports: DataFrame, delay: str) -> DataFrame:
    """Watermarks need an instant; the naive local time stays the key."""
    return reports.withColumn("_event_at", F.col("report_ts").cast("timestamp_ltz")).withWatermark(
        "_event_at", delay
    )


def first_reports(reports: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """First arrived report per vehicle and report time, within the watermark.

    State is one key per report of the last `delay`. Repeats that come later than
    that are dropped or passed on; the batch rebuild settles them.
    """
    timed = _timed(reports, delay)
    return timed.dropDuplicatesWithinWatermark(["mode", "vehicle_id", "report_ts"]).drop("_event_at")


def hourly_delay_estimate(reports: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Hourly reports, delays and estimated vehicles per route, as they come in.

    State is a fixed-size sketch per route and hour still open.
    """
    hours = _timed(reports, delay).groupBy(F.window("_event_at", "1 hour"), "mode", "route_id")
    return hours.agg(
        F.count(F.lit(1)).alias("report_count"),
        delayed().alias("delayed_count"),
        F.approx_count_distinct("vehicle_id").alias("active_vehicles"),
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("hour_start"),
        "mode",
        "route_id",
        "report_count",
        "delayed_count",
        "active_vehicles",
    )


BY_HOUR = ("report_date", "report_hour")
BY_DAY = ("report_date",)


def _folder(touched: Row) -> str:
    """Folder of one hour or day; reports without a time lie in Spark's folder for NULLs."""
    parts = touched.asDict().items()
    return "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in parts)


def hourly_delay_exact(store: TableStore, routes: DataFrame, by: Sequence[str] = BY_HOUR) -> Batch:
    """Keep exact hourly delays: recompute just the hours a batch touches.

    Late reports simply touch an old hour. Reports lie by hour and batch, so a
    batch opens only the folders of its own hours, however long the feed has been
    running, and replaces only those hours' results. The driver sees the batch's
    distinct hours, mostly one or two.

    To catch up on history, where a batch touches hundreds of hours, lay the
    tables out `by` day: fewer, larger folders.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = batch.select(
            "*",
            F.to_date("report_ts").alias("report_date"),
            F.hour("report_ts").alias("report_hour"),
            F.lit(batch_id).alias("batch"),
        )
        if not store.reload_days("reports", dated, [*by, "batch"]):
            return
        root = store.path("reports")
        folders = [f"{root}/{_folder(touched)}" for touched in dated.select(*by).distinct().collect()]
        reader = batch.sparkSession.read.schema(dated.schema).option("basePath", root)
        reports = reader.parquet(*folders).select(*batch.columns)
        staged = vehicle_positions(earliest_reports(reports))
        store.reload_days("hourly", delay_by_route_hour(vehicle_hours(staged), routes), by)

    return handle


def latest_fleet(store: TableStore) -> Batch:
    """Keep the newest report of every vehicle in one table, which each batch replaces.

    A batch shrinks to one row per vehicle before it meets the table, which is as large
    as the fleet, not as its history. Batch numbers don't matter: a batch that comes
    again changes nothing, and a new checkpoint goes on from the table as it is.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest = newest_per_vehicle(batch)
        if store.exists("fleet"):
            newest = newest_per_vehicle(newest.unionByName(store.read("fleet", batch.schema)))
        store.rebuild("fleet", newest)

    return handle


def newest_per_vehicle(reports: DataFrame) -> DataFrame:
    order = ["report_ts", "_ingested_at"]
    return keep_first(reports, ["mode", "vehicle_id"], by=order, descending=["report_ts"])


def fleet(store: TableStore) -> DataFrame:
    """The newest report of every vehicle."""
    return store.read("fleet")


def gated(store: TableStore, suite: str, expectations: Sequence[quality.Expectation]) -> Batch:
    """Check each batch: good rows go on, bad ones to quarantine, results to a log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = quality.split_rows(batch, quality.row_condition(batch, expectations))
            store.rebuild(f"accepted/batch={batch_id}", good)
            store.rebuild(f"quarantine/batch={batch_id}", bad)
            store.rebuild(f"checks/batch={batch_id}", quality.evaluate(suite, batch, expectations))
        finally:
            batch.unpersist()

    return handle


def append_to(store: TableStore, name: str) -> Batch:
    """Land each batch under its number."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.rebuild(f"{name}/batch={batch_id}", batch)

    return handle


def start(
    stream: DataFrame,
    handle: Batch,
    checkpoint: str,
    cadence: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run a stream at a cadence, or over all that is there now if none is given."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": cadence} if cadence else {"availableNow": True}
    return writer.trigger(**trigger).start()
