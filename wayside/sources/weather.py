"""Daily weather responses: parallel arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.schemas import struct

# The archive's variable names.
MEASURES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
]
RESPONSE = "daily struct<time: array<string>, {}>".format(
    ", ".join(f"{name}: array<double>" for name in MEASURES)
)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(struct(RESPONSE)).option("mode", "FAILFAST").json(path)


def conform(responses: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per day; the nth value of every array belongs to the nth day."""
    days = F.arrays_zip("daily.time", *(f"daily.{name}" for name in MEASURES))
    rows = responses.select(F.explode(days).alias("d"), ingested_at.alias("_ingested_at"))
    return rows.select(
        *(F.col(f"d.{name}") for name in MEASURES),
        F.to_date("d.time").alias("date"),
        "_ingested_at",
    )


def within(days: DataFrame, first: str, last: str) -> DataFrame:
    """Days from first to last, both included."""
    return days.where(F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
