"""City open-data pages (JSON lines): road congestion and traffic counts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, LongType, StructType

from wayside.schemas import BRONZE, struct
from wayside.storage import counted, settle

# Page size and start of the loaded slice.
PAGE_ROWS = 50_000
SINCE = "2018-01-01"


def scan(spark: SparkSession, path: str, ingested_at: Column, ddl: str | None = None) -> DataFrame:
    """Records without their nested point objects.

    With a declared schema the file is read once; without one Spark reads everything once more
    to infer the columns, which `scan_found` does not.
    """
    reader = spark.read.schema(struct(ddl)) if ddl else spark.read
    rows = reader.json(path)
    flat = [f.name for f in rows.schema.fields if not isinstance(f.dataType, StructType)]
    return rows.select(*(F.col(f"`{name}`") for name in flat), ingested_at.alias("_ingested_at"))


def scan_found(spark: SparkSession, path: str, ingested_at: Column) -> DataFrame:
    """Records of undeclared fields, without nested objects, from one read of the pages.

    Every record is kept as a variant while the fields of all pages are gathered in the same
    pass, so that a field of a later page is a column as well. Fractions become doubles, and a
    field of different kinds text. A line holds a record or a list of them; blank lines are
    passed over, and a line that is no JSON gives a row of NULLs.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    record = F.try_parse_json("value")
    pages = lines.select(F.explode(F.coalesce(record.try_cast("array<variant>"), F.array(record))).alias("record"))
    seen = Observation()
    records = settle(pages.observe(seen, F.schema_of_variant_agg("record").alias("found")), "records")
    kind = seen.get["found"]
    if not kind.startswith("OBJECT<"):
        return records.where("false").select(ingested_at.alias("_ingested_at"))
    (found,) = StructType.fromDDL("record " + kind.replace("OBJECT<", "STRUCT<")).fields
    kept = [f for f in found.dataType.fields if not isinstance(f.dataType, StructType)]
    columns = [F.try_variant_get("record", f"$[{json.dumps(f.name)}]", _flat(f.dataType)).alias(f.name) for f in kept]
    return records.select(*columns, ingested_at.alias("_ingested_at"))


def _flat(kind: DataType) -> str:
    if isinstance(kind, DecimalType):
        return "double"
    if isinstance(kind, (BooleanType, LongType, DoubleType)):
        return kind.simpleString()
    if isinstance(kind, ArrayType) and not isinstance(kind.elementType, StructType):
        return f"array<{_flat(kind.elementType)}>"
    return "string"


def scan_congestion(spark: SparkSession, path: str, ingested_at: Column) -> DataFrame:
    return scan(spark, path, ingested_at, BRONZE["congestion"])


def congestion_slice(records: DataFrame, since: str | None = SINCE) -> DataFrame:
    """Observations from a start date on, however many.

    ISO text orders like time, so the comparison stays on the raw column and can reach a
    Parquet scan.
    """
    return records if since is None else records.where(F.col("time") >= since)


def land_pages(rows: DataFrame, path: str) -> int:
    """Write part files of at most one page each, in time order over the whole load; gives the row count.

    Times are dealt out by ranges, so files in the order of their names follow each other; a
    time that many rows share takes several ranges.
    """
    frame, seen = counted(rows.repartitionByRange("time", F.xxhash64(*rows.columns)).sortWithinPartitions("time"))
    frame.write.mode("overwrite").option("maxRecordsPerFile", PAGE_ROWS).parquet(path)
    return seen.get["rows"]
