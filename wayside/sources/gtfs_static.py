"""Timetable sets: text members to all-string tables, one snapshot per day."""

from __future__ import annotations

import csv
import datetime as dt
import io
import itertools
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wayside.shipping import ship_package
from wayside.sources import feed_parts
from wayside.storage import TableStore, qualified, settle

_CELL_ROWS = 10_000


def scan_table(spark: SparkSession, folder: str, table: str, ingested_at: Column) -> DataFrame:
    """One text member; ids keep their leading zeros because nothing is inferred."""
    path = f"{folder.rstrip('/')}/{table}.txt"
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.withColumn("_ingested_at", ingested_at)


def members(spark: SparkSession, folder: str) -> list[str]:
    """Names of the text members; a set has a few dozen at most."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    names = files.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("name"))
    return sorted(row["name"] for row in names.collect())


def land_static(
    spark: SparkSession,
    store: TableStore,
    agency: str,
    tables: dict[str, DataFrame],
    snapshot: dt.date,
) -> DataFrame:
    """Write one day's snapshot, replacing an earlier run of the same day.

    Gives one metrics row per table: name, rows, path.
    """
    metrics = []
    for name, rows in tables.items():
        target = f"{agency}/gtfs_static/{name}"
        dated = rows.withColumn("dt", F.lit(snapshot))
        metrics.append((name, store.reload_days(target, dated), store.path(target)))
    return spark.createDataFrame(metrics, "table_name string, row_count bigint, path string")


def scan_zip(spark: SparkSession, path: str, ingested_at: Column) -> dict[str, DataFrame]:
    """The tables of a zipped set, by member name.

    Every text member of every archive is a partition of its own, so a task unpacks one
    member and none reads an archive whole. Records are written once, by member, and every
    table reads its own part; the driver sees only the header lines.
    """
    ship_package(spark)
    spark.dataSource.register(_zip_members())
    zips = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(qualified(spark, path))
    archives = sorted(r["path"] for r in zips.select("path").collect())
    records = spark.read.format("zip_members").option("archives", json.dumps(archives)).load()
    records = settle(records, "zip-records", "member")
    headers: dict[str, list[str]] = {}
    for row in records.where("position = 0").select("member", "cells").distinct().collect():
        if headers.setdefault(row["member"], row["cells"]) != row["cells"]:
            raise ValueError(f"archives disagree on the columns of {row['member']}.txt")
    return {member: _zip_table(records, member, columns, ingested_at) for member, columns in headers.items()}


def _zip_members() -> type[DataSource]:
    """A source with a partition for every text member of some archives.

    Planning reads each archive's directory only. The classes are made here so that they
    travel with the query.
    """

    class Member(InputPartition):
        def __init__(self, archive: str, name: str):
            self.archive, self.name = archive, name

    class Members(DataSourceReader):
        def __init__(self, archives: list[str]):
            self.archives = archives

        def partitions(self):
            found = []
            for archive in self.archives:
                with feed_parts.open_file(archive) as file, zipfile.ZipFile(file) as directory:
                    found += [Member(archive, n) for n in directory.namelist() if n.endswith(".txt")]
            return found

        def read(self, partition):
            with feed_parts.open_file(partition.archive) as file, zipfile.ZipFile(file) as archive, archive.open(partition.name) as raw:
                yield from _records(partition.archive, partition.name[: -len(".txt")], raw)

    class ZipMembers(DataSource):
        @classmethod
        def name(cls) -> str:
            return "zip_members"

        def schema(self) -> str:
            return "archive string, member string, position bigint, cells array<string>"

        def reader(self, schema):
            return Members(json.loads(self.options["archives"]))

    return ZipMembers


def _zip_table(records: DataFrame, member: str, columns: list[str], ingested_at: Column) -> DataFrame:
    cells = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(columns)]
    rows = records.where((F.col("member") == member) & (F.col("position") > 0))
    return rows.select(*cells, ingested_at.alias("_ingested_at"))


def _records(path: str, member: str, raw) -> Iterator[pa.RecordBatch]:
    lines = enumerate(csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline="")))
    while held := list(itertools.islice(lines, _CELL_ROWS)):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([path] * len(held)), pa.array([member] * len(held)), pa.array([i for i, _ in held], pa.int64()),
                pa.array([[cell or None for cell in cells] for _, cells in held], pa.list_(pa.string())),
            ],
            ["archive", "member", "position", "cells"],
        )
