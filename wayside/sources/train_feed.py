"""Train tracker responses to typed position rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.functions.casts import conform_double, strict_timestamp
from wayside.schemas import struct

# Wire names of the feed.
# `train` is one object or a list of them, so it is read as text first.
RESPONSE = "ctatt struct<route: array<struct<`@name`: string, train: string>>>"
TRAINS = (
    "array<struct<rn: string, prdt: string, lat: string, lon: string, heading: string, "
    "destNm: string, destSt: string, nextStaId: string, nextStaNm: string, nextStpId: string, "
    "arrT: string, isApp: string, isDly: string, trDr: string>>"
)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(struct(RESPONSE)).option("mode", "FAILFAST").json(path)


def flatten(responses: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per train, tagged with its line's name.

    Parsing the text as an array turns a lone object into a one-element list and
    an absent `train` into no rows.
    """
    lines = responses.select(F.explode("ctatt.route").alias("line"), ingested_at.alias("_ingested_at"))
    trains = F.from_json("line.train", TRAINS, {"mode": "FAILFAST"})
    return lines.select(
        F.explode(trains).alias("t"), F.col("line.@name").alias("rt"), "_ingested_at"
    ).select("t.*", "rt", "_ingested_at")


def conform(trains: DataFrame) -> DataFrame:
    """Typed rows; the two flags are true only for the text '1'."""
    return trains.select(
        "rn",
        "rt",
        strict_timestamp("prdt").alias("tmstmp"),
        conform_double("lat").alias("lat"),
        conform_double("lon").alias("lon"),
        F.col("heading").try_cast("int").alias("heading"),
        "destNm",
        "destSt",
        "nextStaId",
        "nextStaNm",
        "nextStpId",
        strict_timestamp("arrT").alias("arrT"),
        F.coalesce(F.col("isApp") == "1", F.lit(False)).alias("isApp"),
        F.coalesce(F.col("isDly") == "1", F.lit(False)).alias("isDly"),
        "trDr",
        "_ingested_at",
    )
