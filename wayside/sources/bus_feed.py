"""Bus tracker responses to typed position rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.functions.casts import conform_double, conform_int, strict_timestamp
from wayside.schemas import struct

# Wire names of the feed and its timestamp pattern.
RESPONSE = (
    "`bustime-response` struct<"
    "vehicle: array<struct<vid: string, tmstmp: string, lat: string, lon: string, hdg: string, "
    "pid: bigint, rt: string, des: string, pdist: bigint, dly: boolean, tatripid: string, "
    "origtatripno: string, tablockid: string, zone: string>>, "
    "error: array<struct<rt: string, msg: string>>>"
)
STAMP = "yyyyMMdd HH:mm:ss"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one JSON document per line; broken JSON stops the load."""
    return spark.read.schema(struct(RESPONSE)).option("mode", "FAILFAST").json(path)


def conform(responses: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per vehicle; a response with only an error explodes to no rows."""
    reports = responses.select(
        F.explode("bustime-response.vehicle").alias("v"), ingested_at.alias("_ingested_at")
    )
    return reports.select(
        "v.vid",
        strict_timestamp("v.tmstmp", STAMP).alias("tmstmp"),
        conform_double("v.lat").alias("lat"),
        conform_double("v.lon").alias("lon"),
        F.col("v.hdg").try_cast("int").alias("hdg"),
        "v.pid",
        "v.rt",
        "v.des",
        "v.pdist",
        F.coalesce("v.dly", F.lit(False)).alias("dly"),
        "v.tatripid",
        "v.origtatripno",
        "v.tablockid",
        F.nullif("v.zone", F.lit("")).alias("zone"),
        "_ingested_at",
    )
