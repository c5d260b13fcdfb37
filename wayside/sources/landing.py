"""Reading what has landed: typed scans, the newest snapshot, the newest poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayside.schemas import struct
from wayside.storage import folders


def typed_scan(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    """All parts below a root, with `dt` directories found as a partition column."""
    return spark.read.schema(struct(ddl)).parquet(root)


def _newest_folder(spark: SparkSession, root: str) -> str:
    """The lexically newest folder in another; lists that one level only."""
    found = folders(spark, root)
    if not found:
        raise LookupError(f"nothing landed under {root}")
    return f"{root.rstrip('/')}/{found[-1]}"


def newest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the newest `dt=` snapshot only, with its own columns; an error if there is none."""
    return spark.read.parquet(_newest_folder(spark, root))


def newest_poll(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    """All rows of the poll landed last: every file of the newest folder of the newest day."""
    day = _newest_folder(spark, root)
    return spark.read.schema(struct(ddl)).parquet(_newest_folder(spark, day))
