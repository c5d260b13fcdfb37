"""The given tables bound to landed feeds, and the lakes built from them."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.plans import lakehouse
from wayside.storage import TableStore, fresh_folder


# Declared, so that opening a table costs no schema job.
GIVEN = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def hour_start(ts: str) -> Column:
    """Start of the hour, without leaving the naive timestamp type."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def _lat() -> Column:
    return F.lit(41.0) + (F.col("event_id") % 203).cast("double") / 100


def _lon() -> Column:
    return F.lit(-89.0) + (F.col("event_id") % 207).cast("double") / 100


def _route() -> Column:
    return F.concat(F.lit("NATION_"), text(F.col("user_id") % 30))


def is_bus() -> Column:
    return F.col("user_id") % 4 != 0


def bus_rows(events: DataFrame) -> DataFrame:
    return events.where(is_bus()).select(
        text("user_id").alias("vid"),
        hour_start("ts").alias("tmstmp"),
        _lat().alias("lat"),
        _lon().alias("lon"),
        (F.col("event_id") % 360).cast("int").alias("hdg"),
        (F.col("user_id") % 50).alias("pid"),
        _route().alias("rt"),
        F.col("event_type").alias("des"),
        (F.col("event_id") % 5000).alias("pdist"),
        (F.col("event_type") == "error").alias("dly"),
        text("event_id").alias("tatripid"),
        text(F.col("event_id") % 1000).alias("origtatripno"),
        text(F.col("user_id") % 30).alias("tablockid"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Z"), text(F.col("event_id") % 3))).alias("zone"),
        F.col("ts").alias("_ingested_at"),
    )


def decoded_train_rows(events: DataFrame) -> DataFrame:
    return events.where(~is_bus()).select(
        text("user_id").alias("vehicle_id"),
        _route().alias("route_id"),
        _lat().alias("lat"),
        _lon().alias("lon"),
        (F.col("event_id") % 360).cast("int").alias("heading"),
        (F.col("event_type") == "error").alias("is_delayed"),
        text(F.col("event_id") % 40).alias("stop_id"),
        hour_start("ts").alias("report_ts"),
    )


def route_rows(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_name").alias("route_id"),
        text("n_nationkey").alias("route_short_name"),
        F.concat(F.lit("Line "), "n_name").alias("route_long_name"),
        text(F.col("n_nationkey") % 5).alias("route_type"),
        F.lit("FF0000").alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
    )


def _one_of(key: Column, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def stop_rows(supplier: DataFrame) -> DataFrame:
    key, area = F.col("s_suppkey"), F.col("s_nationkey") % 3
    return supplier.select(
        text(key).alias("stop_id"),
        F.concat(F.lit("C"), text(key)).alias("stop_code"),
        F.col("s_name").alias("stop_name"),
        F.when(key % 10 == 9, "").otherwise(text(area + 41)).alias("stop_lat"),
        text(area - 89).alias("stop_lon"),
        _one_of(key, "0", "1", "2.7", " 7 ", "", "abc", "1e3").alias("location_type"),
        F.when(key % 4 == 0, text(key % 11)).alias("parent_station"),
        _one_of(key, "1", "2.5", "-2.5").alias("wheelchair_boarding"),
    )


def trip_rows(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        F.concat(F.lit("NATION_"), text(F.col("o_custkey") % 27)).alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
        text(key).alias("trip_id"),
        _one_of(key, "Northbound", "Southbound", "Eastbound").alias("direction"),
        text(key % 2).alias("direction_id"),
        text(key % 97).alias("block_id"),
        F.col("o_orderstatus").alias("shape_id"),
        F.concat(F.lit("S"), text(key)).alias("schd_trip_id"),
        _one_of(key, "0", "1", "x").alias("wheelchair_accessible"),
    )


def stop_time_rows(lineitem: DataFrame) -> DataFrame:
    clock = F.concat(
        F.lpad(text(F.col("l_partkey") % 28), 2, "0"),
        F.lit(":"),
        F.lpad(text(F.col("l_suppkey") % 60), 2, "0"),
        F.lit(":00"),
    )
    return lineitem.select(
        text("l_orderkey").alias("trip_id"),
        text("l_suppkey").alias("stop_id"),
        clock.alias("arrival_time"),
        clock.alias("departure_time"),
        text("l_linenumber").alias("stop_sequence"),
        F.concat(F.lit("To "), "l_returnflag").alias("stop_headsign"),
        F.lit("0").alias("pickup_type"),
        F.concat(text(F.col("l_partkey") % 100), F.lit(".5")).alias("shape_dist_traveled"),
    )


def congestion_rows(lineitem: DataFrame) -> DataFrame:
    segment, part = F.col("l_suppkey"), F.col("l_partkey")
    day = F.date_add(F.lit("2018-01-01").cast("date"), (part % 60).cast("int"))
    iso = F.concat(text(day), F.lit("T"), F.lpad(text(part % 24), 2, "0"), F.lit(":00:00.000"))
    two = F.lpad(text(segment % 100), 2, "0")
    return lineitem.select(
        text(segment).alias("segment_id"),
        iso.alias("time"),
        text(F.col("l_quantity").cast("int") - 3).alias("speed"),
        F.concat(F.lit("Street "), text(segment)).alias("street"),
        _one_of(segment, "NB", "SB", "EB", "WB").alias("direction"),
        F.concat(F.lit("From "), text(segment % 7)).alias("from_street"),
        F.concat(F.lit("To "), text(segment % 5)).alias("to_street"),
        F.concat(text(segment % 9), F.lit(".5")).alias("length"),
        text("l_linenumber").alias("bus_count"),
        text(F.col("l_orderkey") % 30).alias("message_count"),
        text(part % 24).alias("hour"),
        text(part % 60 % 7 + 1).alias("day_of_week"),
        text(F.month(day)).alias("month"),
        F.concat(F.lit("41."), two).alias("start_latitude"),
        F.concat(F.lit("-87."), two).alias("start_longitude"),
        F.concat(F.lit("42."), two).alias("end_latitude"),
        F.concat(F.lit("-88."), two).alias("end_longitude"),
        _seconds_after("2018-04-01", "l_orderkey").alias("_ingested_at"),
    )


def _seconds_after(day: str, seconds: str) -> Column:
    start = F.lit(day).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(seconds).cast("decimal(18,6)"))


def weather_rows(orders: DataFrame) -> DataFrame:
    price, cust = F.col("o_totalprice"), F.col("o_custkey")
    return orders.select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 40).cast("int")).alias("date"),
        (price / 20000).alias("temperature_2m_max"),
        (price / 20000 - 5).alias("temperature_2m_min"),
        (cust % 4).cast("double").alias("precipitation_sum"),
        (cust % 2).cast("double").alias("rain_sum"),
        (cust % 3).cast("double").alias("snowfall_sum"),
        (cust % 60).cast("double").alias("wind_speed_10m_max"),
        (cust % 90).cast("double").alias("wind_gusts_10m_max"),
        _seconds_after("2024-03-01", "o_orderkey").alias("_ingested_at"),
    )


# Landed table: the given table it is bound to, and how.
LANDED = {
    "bus_positions": ("events", bus_rows),
    "decoded_trains": ("events", decoded_train_rows),
    "routes": ("nation", route_rows),
    "stops": ("supplier", stop_rows),
    "trips": ("orders", trip_rows),
    "stop_times": ("lineitem", stop_time_rows),
    "congestion": ("lineitem", congestion_rows),
    "weather": ("orders", weather_rows),
}


class Landed(Mapping):
    """Landed tables by name, each bound when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.bound: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.bound:
            source, bind = LANDED[name]
            self.bound[name] = bind(given(self.spark, self.sf_dir, source))
        return self.bound[name]

    def __iter__(self):
        return iter(LANDED)

    def __len__(self):
        return len(LANDED)


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the graph as a single plan over the given tables."""
    return lakehouse.derive(spark, Landed(spark, sf_dir), name)


_BUILT: dict[tuple[str, str], tuple[dict[str, DataFrame], dict[str, int], TableStore]] = {}


def built(spark: SparkSession, sf_dir: str, *names: str) -> tuple[dict[str, DataFrame], dict[str, int], TableStore]:
    """The named tables of the lake and what they need, written to shared storage, each once per application and scale.

    Without names it is the whole lake.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = {}, {}, TableStore(spark, fresh_folder(spark, "lake"))
    tables, rows, store = _BUILT[key]
    made, count = lakehouse.build(spark, ChainMap(dict(tables), Landed(spark, sf_dir)), store, only=names or None)
    tables.update(made)
    rows.update(count)
    return tables, rows, store


def rounded(df: DataFrame, *doubles: str, digits: int = 9) -> DataFrame:
    """Named doubles cut to a comparable precision: sums differ in the last bits by task order."""
    return df.withColumns({c: F.round(c, digits) for c in doubles})
