"""Landed response files written from the given tables, once per application."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.inputs import Landed, _lat, _lon, given, hour_start, is_bus, text
from wayside.plans.rules import RAIL_LINES
from wayside.sources.bus_feed import STAMP
from wayside.sources.open_data import PAGE_ROWS
from wayside.sources.weather import MEASURES
from wayside.shipping import ship_package
from wayside.storage import fresh_folder, open_folder, qualified

LOADED_AT = "2024-06-01"


def loaded_at() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(write: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """Give the folder a writer fills; it runs the first time it is asked for."""

    @wraps(write)
    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, write.__name__)
        if key not in _WRITTEN:
            path = fresh_folder(spark, write.__name__)
            write(spark, sf_dir, path)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    return folder


def _response() -> Column:
    return F.expr("event_id div 50")


def _unless(divisor: int, value: Column, otherwise) -> Column:
    return F.when(F.col("event_id") % divisor == 0, otherwise).otherwise(value)


@_once
def timetable(spark, sf_dir, path):
    landed = Landed(spark, sf_dir)
    as_is = {"emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for name in ("routes", "stops", "trips", "stop_times"):
        landed[name].write.options(header=True, **as_is).csv(f"{path}/{name}.txt")


@_once
def zipped_stop_times(spark, sf_dir, path):
    """Stop times in archives, one for each task of the scan, each with a second member; rows are streamed into them."""
    rows = Landed(spark, sf_dir)["stop_times"]
    columns, root = rows.columns, qualified(spark, path)

    def pack(batches):
        files, folder = open_folder(root)
        files.create_dir(folder, recursive=True)
        part, count = TaskContext.get().partitionId(), 0
        with files.open_output_stream(f"{folder}/set-{part:05}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            with archive.open("stop_times.txt", "w") as raw, io.TextIOWrapper(raw, "utf-8", newline="") as text:
                lines = csv.writer(text)
                lines.writerow(columns)
                for batch in batches:
                    lines.writerows(zip(*(c.to_pylist() for c in batch.columns), strict=True))
                    count += batch.num_rows
            archive.writestr("feed_info.txt", f"feed_publisher_name,rows\ncity,{count}\n")
        yield pa.RecordBatch.from_pydict({"rows": pa.array([count], pa.int64())})

    ship_package(spark)
    rows.mapInArrow(pack, "rows long").agg(F.sum("rows")).collect()


@_once
def bus_responses(spark, sf_dir, path):
    """Fifty reports per response; every twentieth response holds only an error."""
    event = F.col("event_id")
    late = F.col("event_type") == "error"
    vehicle = F.struct(
        text("user_id").alias("vid"),
        _unless(31, F.date_format(hour_start("ts"), STAMP), "").alias("tmstmp"),
        _unless(97, text(_lat()), "n/a").alias("lat"),
        text(_lon()).alias("lon"),
        _unless(89, text(event % 360), "north").alias("hdg"),
        (F.col("user_id") % 50).alias("pid"),
        F.concat(F.lit("NATION_"), text(F.col("user_id") % 30)).alias("rt"),
        F.col("event_type").alias("des"),
        (event % 5000).alias("pdist"),
        F.when(late | (event % 5 != 0), late).alias("dly"),
        _unless(3, F.concat(F.lit("Z"), text(event % 3)), "").alias("zone"),
    )
    reports = given(spark, sf_dir, "events").where(is_bus()).groupBy(_response().alias("response"))
    found = F.to_json(F.struct(F.struct(F.collect_list(vehicle).alias("vehicle")).alias("bustime-response")))
    failed = F.lit('{"bustime-response": {"error": [{"rt": "1", "msg": "No data found for parameter"}]}}')
    bodies = reports.agg(found.alias("found"))
    bodies.select(F.when(F.col("response") % 20 == 19, failed).otherwise(F.col("found"))).write.text(path)


@_once
def train_responses(spark, sf_dir, path):
    """Trains by line; a lone train is an object, an idle line has none."""
    event = F.col("event_id")
    line = F.element_at(F.array(*map(F.lit, RAIL_LINES)), F.expr("cast(user_id div 4 % 8 + 1 as int)"))
    train = F.to_json(F.struct(
        text("user_id").alias("rn"),
        F.date_format(hour_start("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("prdt"),
        text(_lat()).alias("lat"),
        _unless(97, text(_lon()), "n/a").alias("lon"),
        text(event % 360).alias("heading"),
        F.lit("Loop").alias("destNm"),
        text(event % 40).alias("nextStpId"),
        _unless(11, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "").alias("arrT"),
        text((event % 2)).alias("isApp"),
        F.when(F.col("event_type") == "error", "1").when(event % 3 != 0, "0").alias("isDly"),
    ))
    trains = given(spark, sf_dir, "events").where(~is_bus())
    lines = trains.groupBy(_response().alias("response"), line.alias("line")).agg(F.collect_list(train).alias("t"))
    listed = F.when(F.size("t") == 1, F.col("t")[0]).otherwise(F.concat(F.lit("["), F.array_join("t", ","), F.lit("]")))
    entry = F.concat(F.lit('{"@name":"'), "line", F.lit('","train":'), listed, F.lit("}"))
    bodies = lines.groupBy("response").agg(F.array_join(F.collect_list(entry), ",").alias("lines"))
    bodies.select(F.concat(F.lit('{"ctatt":{"route":[{"@name":"idle"},'), "lines", F.lit("]}}"))).write.text(path)


@_once
def open_data_pages(spark, sf_dir, path):
    point = F.struct(F.lit("Point").alias("type"), F.array("start_longitude", "start_latitude").alias("coordinates"))
    rows = Landed(spark, sf_dir)["congestion"].drop("_ingested_at")
    # Compressed pages can't be split, so each holds at most a page of the provider.
    rows.withColumn("_start_point", point).write.option("maxRecordsPerFile", PAGE_ROWS).json(path, compression="gzip")


@_once
def weather_responses(spark, sf_dir, path):
    """One response per month, its days as parallel arrays (31 entries at most)."""
    days = Landed(spark, sf_dir)["weather"].groupBy("date").agg(*(F.max(m).alias(m) for m in MEASURES))
    months = days.groupBy(F.trunc("date", "month").alias("month")).agg(
        F.sort_array(F.collect_list(F.struct("date", *MEASURES))).alias("d")
    )
    body = F.struct(F.col("d.date").cast("array<string>").alias("time"), *(F.col(f"d.{m}").alias(m) for m in MEASURES))
    months.select(F.to_json(F.struct(body.alias("daily")), {"ignoreNullFields": "false"})).write.text(path)


@_once
def bus_days(spark, sf_dir, path):
    """Conformed bus reports in a folder for each day."""
    rows = Landed(spark, sf_dir)["bus_positions"].withColumn("dt", F.to_date("_ingested_at"))
    rows.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)


@_once
def bus_polls(spark, sf_dir, path):
    """Conformed bus reports in a folder for each day and hourly poll, as loads leave them."""
    rows = Landed(spark, sf_dir)["bus_positions"].withColumn("dt", F.to_date("_ingested_at"))
    rows = rows.withColumn("poll", F.date_format("_ingested_at", "yyyyMMdd'T'HH'0000'"))
    rows.write.partitionBy("dt", "poll").parquet(path)


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed train reports with their poll's time: one poll per day."""
    event = F.col("event_id")
    rows = given(spark, sf_dir, "events").where(~is_bus())
    columns = {
        "rn": text("user_id"),
        "rt": F.concat(F.lit("NATION_"), text(F.col("user_id") % 30)),
        "tmstmp": hour_start("ts"),
        "lat": _lat(),
        "lon": _lon(),
        "heading": (event % 360).cast("int"),
        "nextStpId": text(event % 40),
        "isApp": event % 2 == 0,
        "isDly": F.col("event_type") == "error",
        "_ingested_at": F.col("ts"),
        "feed_ts": F.to_date("ts").cast("timestamp_ntz"),
    }
    return rows.select(*(c.alias(name) for name, c in columns.items()))


@_once
def train_polls(spark, sf_dir, path):
    """Train reports in folders named after their poll."""
    poll = F.concat(F.lit("trains_"), F.date_format("feed_ts", "yyyyMMdd'T'HHmmss"))
    train_rows(spark, sf_dir).withColumn("poll", poll).drop("feed_ts").hint("rebalance", "poll").write.partitionBy(
        "poll"
    ).parquet(path)
