"""Live tables kept by keyed state: what a batch costs follows the batch, not the history.

State holds one report per key and lets through only rows that change something. They go to
a log with a folder for each batch, which a repeated batch replaces; a table is what its
log says last. State that has expired lets a row through once too often, never too seldom,
and the log's order settles it, so results don't depend on it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from wayside.functions.picking import keep_first
from wayside.functions.ranking import global_rank
from wayside.operators.intermediate import named_route_hours
from wayside.storage import TableStore, settle
from wayside.streaming.positions import Batch, newest_per_vehicle

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Days without a change after which a key's state goes, in queries that run for ever.
LASTS = 7

REPORT = ["mode", "vehicle_id", "report_ts"]
#: What a correction takes back.
TOLD = ("agency", "route_id", "is_delayed")


def _processor(schema: StructType, by: Sequence[str], descending: Sequence[str], told: Sequence[str], lasts: int) -> StatefulProcessor:
    """Keeps the first row of each key in the order of `keep_first`, and emits it when it changes, with parts of the one before.

    The class is made here so that it travels with the query: the driver's runner of stateful
    queries has no files of this package.
    """
    names = schema.names
    order = [*by, *(c for c in names if c not in by)]
    out = [*names, "corrects", *(f"old_{c}" for c in told)]
    latest = dt.datetime.max

    class First(StatefulProcessor):
        def init(self, handle) -> None:
            self.held = handle.getValueState("first", schema, lasts)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            best = min((tuple(row[c] for c in names) for row in rows), key=self.place)
            before = tuple(self.held.get()) if self.held.exists() else None
            if before is None or self.place(best) < self.place(before):
                self.held.update(best)
                old = [None if before is None else before[names.index(c)] for c in told]
                yield Row(*out)(*best, before is not None, *old)

        def place(self, row: tuple) -> list:
            values = ((c, row[names.index(c)]) for c in order)
            return [(v is None, 0 if v is None else latest - v if c in descending else v) for c, v in values]

        def close(self) -> None:
            pass

    return First()


def _rocks(reports: DataFrame) -> None:
    spark = reports.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != _ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


def _expiring(reports: DataFrame, keys: list[str], by: tuple[str, ...], descending, told, lasts_days: float) -> DataFrame:
    """First rows by a processor, which lets state go: a call for each key, so for feeds, not for history."""
    _rocks(reports)
    out = StructType([*reports.schema.fields]).add("corrects", "boolean")
    for c in told:
        out = out.add(f"old_{c}", reports.schema[c].dataType)
    lasts = int(lasts_days * 86_400_000)
    processor = _processor(reports.schema, by, descending, told, lasts)
    return reports.groupBy(*keys).transformWithState(processor, out, "Update", "ProcessingTime")


def _firsts(reports: DataFrame, keys: list[str], by: tuple[str, ...], descending=()) -> DataFrame:
    """First rows by an aggregate that keeps its state: the smallest row of each key, and the batches that had the key.

    `current_timestamp` is one value within a batch, also when the batch is repeated.
    """
    _rocks(reports)
    now = F.current_timestamp()
    names = reports.columns
    order = [*by, *(c for c in names if c not in by)]
    place = []
    for i, c in enumerate(order):
        value = -F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', `{c}`)") if c in descending else F.col(c)
        place += [F.col(c).isNull().alias(f"n{i}"), value.alias(f"v{i}")]
    best = F.struct(*place, F.col("_batch").alias("batch"), F.struct(*names).alias("row"))
    kept = reports.withColumn("_batch", now).groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        F.min(best).alias("best"), F.min("_batch").alias("first"), F.max("_batch").alias("last")
    )
    corrects = (F.col("first") != now) | (F.col("last") != now)
    return kept.where(F.col("best.batch") == now).select("best.row.*", corrects.alias("corrects"))


def fleet_changes(reports: DataFrame, lasts_days: float | None = None) -> DataFrame:
    """Stream of reports that are the newest of their vehicle so far: one row of state per vehicle.

    With `lasts_days`, for queries that run at a cadence, a vehicle without news loses its row.
    """
    how = (["mode", "vehicle_id"], ("report_ts", "_ingested_at"), ("report_ts",))
    changes = _firsts(reports, *how) if lasts_days is None else _expiring(reports, *how, (), lasts_days)
    return changes.drop("corrects")


def earliest_changes(reports: DataFrame, lasts_days: float | None = None) -> DataFrame:
    """Stream of the earliest ingested report per vehicle and report time, and of later corrections.

    A report that arrives after another of the same key, but was ingested before it, is a
    correction: `corrects` is true. With `lasts_days`, old_agency, old_route_id and
    old_is_delayed are what it replaces; else `hourly_bitmaps` finds that in the log.
    """
    if lasts_days is None:
        return _firsts(reports, REPORT, ("_ingested_at",))
    return _expiring(reports, REPORT, ("_ingested_at",), (), TOLD, lasts_days)


def _run(batch: DataFrame) -> str:
    """The query a batch belongs to: the same after a restart, another one for a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def log_to(store: TableStore, name: str, *by: str) -> Batch:
    """Write each batch's changes to a log, in folders of their own."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.select("*", F.lit(_run(batch)).alias("run"), F.lit(batch_id).alias("batch"))
        store.reload_days(name, marked, [*by, "run", "batch"])

    return handle


def _fleet_parts(store: TableStore, name: str) -> tuple[DataFrame, DataFrame | None]:
    """The log, also one whose folders have all been compacted, and the compacted table if there is one."""
    if not store.exists(f"{name}_base"):
        return store.read(name), None
    base = store.read(f"{name}_base")
    return store.read(name, StructType([*base.schema.fields]).add("run", "string").add("batch", "long")), base


def fleet(store: TableStore, name: str = "fleet_log") -> DataFrame:
    """The newest report of every vehicle: the compacted table and the batches after it."""
    log, base = _fleet_parts(store, name)
    log = log.drop("run", "batch")
    return newest_per_vehicle(log if base is None else log.unionByName(base))


def compact_fleet(store: TableStore, name: str = "fleet_log") -> int:
    """Put the log's rows into one table and let go of the folders read; gives the number of vehicles.

    Batches that are written meanwhile stay. A compaction that is lost before the folders go
    leaves rows twice, which changes nothing.
    """
    log, base = _fleet_parts(store, name)
    done = [(r["run"], r["batch"]) for r in log.select("run", "batch").distinct().collect()]
    if not done:
        return 0 if base is None else base.count()
    rows = log.where(F.struct("run", "batch").isin([F.struct(F.lit(a), F.lit(b)) for a, b in done])).drop("run", "batch")
    kept = store.rebuild(f"{name}_base", newest_per_vehicle(rows if base is None else rows.unionByName(base)))
    for run, batch in done:
        store.drop(f"{name}/run={run}/batch={batch}")
    return kept


def earliest(store: TableStore, days: list[dt.date] | None = None, name: str = "reports_log") -> DataFrame:
    """The earliest report of every key as the log has it, corrections applied; of some days only those are read."""
    log = store.read(name)
    if days is not None:
        log = log.where(F.col("report_date").isin(days))
    columns = [c for c in log.columns if c not in ("run", "batch", "corrects", "report_date") and not c.startswith("old_")]
    return keep_first(log.select(*columns), REPORT, by=["_ingested_at"])


def settle_days(store: TableStore, days: list[dt.date], target: str, name: str = "reports_log") -> int:
    """Bring days of a target table up to date with the log: corrected days, or those that have ended."""
    rows = earliest(store, days, name).withColumn("report_date", F.to_date("report_ts"))
    return store.reload_days(target, rows, ["report_date"])


ROUTE_HOUR = ["agency", "mode", "route_id", "report_date", "report_hour"]


def _numbered(store: TableStore, batch: DataFrame, batch_id: int) -> DataFrame:
    """(mode, vehicle_id, number) of all vehicles so far; new ones get the next numbers.

    A repeated batch finds the dictionary as it was before it, and gives the same numbers.
    """
    ddl = "mode string, vehicle_id string, number bigint, run string, batch bigint"
    spark = batch.sparkSession
    known = store.read("vehicles", ddl) if store.exists("vehicles") else spark.createDataFrame([], ddl)
    known = known.where((F.col("run") != _run(batch)) | (F.col("batch") != batch_id)).drop("run", "batch")
    seen = batch.where("vehicle_id is not null").select("mode", "vehicle_id").distinct()
    # Written, not cached: a cached plan keeps all the reducers its shuffles start with.
    fresh = settle(seen.join(known, ["mode", "vehicle_id"], "left_anti"), "fresh-vehicles")
    if fresh.isEmpty():
        return known
    top = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    placed = global_rank(fresh.withColumn("key", F.struct("mode", "vehicle_id")), "key", "place")
    fresh = placed.select("mode", "vehicle_id", (F.col("place") + top).alias("number"))
    log_to(store, "vehicles")(fresh, batch_id)
    return store.read("vehicles", ddl).select("mode", "vehicle_id", "number")


def _told(store: TableStore, batch: DataFrame, batch_id: int) -> DataFrame:
    """The batch with what its corrections replace: the earliest report of their keys in the query's batches before.

    Only the log's folders of days that have a correction are read, none without one.
    """
    if all(f"old_{c}" in batch.columns for c in TOLD):
        return batch
    days = [r[0] for r in batch.where("corrects").select("report_date").distinct().collect()]
    if not days or not store.exists("reports_log"):
        return batch.withColumns({f"old_{c}": F.lit(None).cast(batch.schema[c].dataType) for c in TOLD})
    log = store.read("reports_log")
    on_days = F.col("report_date").isin([d for d in days if d is not None])
    log = log.where(on_days | F.col("report_date").isNull() if None in days else on_days)
    log = log.where((F.col("run") == _run(batch)) & (F.col("batch") < batch_id))
    columns = [c for c in batch.columns if c not in ("corrects", "report_date", "report_hour")]
    before = keep_first(log.select(*columns), REPORT, by=["_ingested_at"])
    before = before.select(*(F.col(c).alias(f"_{c}") for c in REPORT), *(F.col(c).alias(f"old_{c}") for c in TOLD))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in REPORT]
    return batch.join(before, [F.col("corrects"), *same], "left").drop(*(f"_{c}" for c in REPORT))


def hourly_bitmaps(store: TableStore) -> Batch:
    """Keep hourly reports, delays and exact vehicles by merging: takes the batches of `earliest_changes`.

    A batch adds a row for each route and hour it touches: what its reports add, and a bitmap of
    their vehicles over a dictionary. A late report is one more row and reads no old report.
    A correction takes back what it replaces, found in the log of its day; where it moves a report to another route, the
    hour it leaves is marked, and only marked hours are counted again from the log.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        given = batch.withColumns({"report_date": F.to_date("report_ts"), "report_hour": F.hour("report_ts")}).persist()
        batch = given
        try:
            batch = _told(store, given, batch_id)
            if batch is not given:
                batch = batch.persist()
            log_to(store, "reports_log", "report_date")(batch, batch_id)
            numbered = batch.join(_numbered(store, batch, batch_id), ["mode", "vehicle_id"], "left")
            moved = F.col("corrects") & ~F.col("route_id").eqNullSafe(F.col("old_route_id"))
            hour = ["mode", "report_date", "report_hour", "number"]
            added = numbered.select(
                "agency", "route_id", *hour, F.lit(1).alias("reports"), _one("is_delayed").alias("delays"), F.lit(False).alias("left"),
            )
            taken = numbered.where("corrects").select(
                F.col("old_agency").alias("agency"), F.col("old_route_id").alias("route_id"), *hour[:3],
                F.when(~moved, F.col("number")).alias("number"), F.lit(-1).alias("reports"), (-_one("old_is_delayed")).alias("delays"), moved.alias("left"),
            )
            bucket = F.bitmap_bucket_number("number").alias("bucket")
            parts = added.unionByName(taken).groupBy(*ROUTE_HOUR, bucket).agg(
                F.sum("reports").alias("reports"),
                F.sum("delays").alias("delays"),
                F.max("left").alias("left"),
                F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("vehicles"),
            )
            log_to(store, "hour_parts", "report_date")(parts, batch_id)
        finally:
            batch.unpersist()
            given.unpersist()

    return handle


def _one(flag: str):
    return F.when(F.col(flag), 1).otherwise(0)


def hourly(store: TableStore, routes: DataFrame, days: list[dt.date] | None = None) -> DataFrame:
    """Reports, delays and distinct vehicles by route, day and hour, merged from the parts of all or some days."""
    parts = store.read("hour_parts")
    if days is not None:
        parts = parts.where(F.col("report_date").isin(days))
    merged = parts.groupBy(*ROUTE_HOUR, "bucket").agg(
        F.sum("reports").alias("reports"), F.sum("delays").alias("delays"), F.max("left").alias("left"), F.bitmap_or_agg("vehicles").alias("vehicles")
    )
    totals = merged.groupBy(*ROUTE_HOUR).agg(
        F.sum("reports").alias("reports"),
        F.sum("delays").alias("delays"),
        F.max("left").alias("left"),
        F.sum(F.bitmap_count("vehicles")).alias("vehicles"),
    ).where("reports > 0")
    marked = totals.where("left").select(*ROUTE_HOUR)
    again = earliest(store, days).withColumns({"report_date": F.to_date("report_ts"), "report_hour": F.hour("report_ts")})
    again = again.join(marked, _same(again, marked), "left_semi").groupBy(*ROUTE_HOUR).agg(F.countDistinct("vehicle_id").alias("counted"))
    totals = totals.alias("t").join(again.alias("c"), [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ROUTE_HOUR], "left")
    vehicles = F.when(F.col("left"), F.col("counted")).otherwise(F.col("vehicles"))
    return named_route_hours(totals.select("t.*", vehicles.alias("active_vehicles")).drop("left", "vehicles"), routes)


def _same(a: DataFrame, b: DataFrame):
    out = F.lit(True)
    for k in ROUTE_HOUR:
        out = out & a[k].eqNullSafe(b[k])
    return out
