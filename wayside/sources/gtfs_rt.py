"""GTFS-Realtime vehicle positions: feed files to rows and rows to feed files.

The message layout follows the public GTFS-Realtime specification; only the
fields used here are declared, unknown ones are skipped by the decoder.
"""

from __future__ import annotations

import datetime as dt
import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayside.functions.boxes import in_box
from wayside.schemas import BRONZE
from wayside.shipping import ship_package
from wayside.sources import feed_parts
from wayside.storage import TableStore, folders, open_folder, qualified

# Field numbers and enum numbers of the specification.
_LAYOUT = {
    "FeedHeader": [
        ("gtfs_realtime_version", 1, "string"),
        ("incrementality", 2, "int32"),
        ("timestamp", 3, "uint64"),
    ],
    "TripDescriptor": [("trip_id", 1, "string"), ("route_id", 5, "string")],
    "VehicleDescriptor": [("id", 1, "string"), ("label", 2, "string")],
    "Position": [("latitude", 1, "float"), ("longitude", 2, "float"), ("bearing", 3, "float")],
    "VehiclePosition": [
        ("trip", 1, "TripDescriptor"),
        ("position", 2, "Position"),
        ("current_status", 4, "int32"),
        ("timestamp", 5, "uint64"),
        ("congestion_level", 6, "int32"),
        ("stop_id", 7, "string"),
        ("vehicle", 8, "VehicleDescriptor"),
    ],
    "FeedEntity": [("id", 1, "string"), ("vehicle", 4, "VehiclePosition")],
    "FeedMessage": [("header", 1, "FeedHeader"), ("entity", 2, "*FeedEntity")],
}
VERSION = "2.0"
FULL_DATASET = 0
INCOMING_AT, IN_TRANSIT_TO = 0, 2
RUNNING_SMOOTHLY, CONGESTION = 1, 3

# Rows of a task's output batch, and entities of a chunk, at most.
BATCH, CHUNK = 10_000, 1_000

_CHUNKS = "path string, dt date, entities int, content binary"


def _kept(value):
    """A value, or None for whatever stands for a missing one."""
    return None if value is None or value != value or value is pd.NaT or value == "" else value


class Wire(NamedTuple):
    """One fact of a vehicle entity: where it lies, and how it is written and read.

    `source` is the train column that feeds it and `write` makes the wire value of that
    column; None leaves the field out. `column` is the decoded column it gives, if any,
    and `read` makes that column's value of the field, which is None where it is absent.
    """

    path: str
    source: str
    write: Callable = _kept
    column: str | None = None
    read: Callable = _kept


WIRE = [
    Wire("vehicle.id", "rn", column="vehicle_id"),
    Wire("trip.route_id", "rt", column="route_id"),
    Wire("position.latitude", "lat", column="lat", read=lambda v: v or 0.0),
    Wire("position.longitude", "lon", column="lon", read=lambda v: v or 0.0),
    Wire("position.bearing", "heading", column="heading", read=lambda v: None if v is None else int(v)),
    Wire("congestion_level", "isDly", lambda v: CONGESTION if _kept(v) else RUNNING_SMOOTHLY, "is_delayed", lambda v: v == CONGESTION),
    Wire("stop_id", "nextStpId", column="stop_id"),
    Wire("timestamp", "seen_at", lambda v: int(v) if _kept(v) else None, "report_ts"),
    Wire("current_status", "isApp", lambda v: INCOMING_AT if _kept(v) else IN_TRANSIT_TO),
]


@cache
def feed_message():
    """The FeedMessage class, built once per Python worker."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as missing:
        raise RuntimeError("GTFS-Realtime files need the protobuf package") from missing

    proto = descriptor_pb2.FieldDescriptorProto
    scalars = {
        "string": proto.TYPE_STRING,
        "int32": proto.TYPE_INT32,
        "uint64": proto.TYPE_UINT64,
        "float": proto.TYPE_FLOAT,
    }
    file = descriptor_pb2.FileDescriptorProto(name="wayside_rt.proto", package="wayside_rt", syntax="proto2")
    for message, fields in _LAYOUT.items():
        declared = file.message_type.add(name=message)
        for name, number, kind in fields:
            repeated = kind.startswith("*")
            field = declared.field.add(name=name, number=number)
            field.label = proto.LABEL_REPEATED if repeated else proto.LABEL_OPTIONAL
            if kind in scalars:
                field.type = scalars[kind]
            else:
                field.type = proto.TYPE_MESSAGE
                field.type_name = f".wayside_rt.{kind.lstrip('*')}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("wayside_rt.FeedMessage"))


def read_feeds(spark: SparkSession, path: str, part: int = feed_parts.PART) -> DataFrame:
    """Parts of the feed files below a path, any depth of `dt=` folders: what `decode` and `headers` take.

    No task reads more than a part at once, so a file may be of any size.
    """
    return feed_parts.scan(spark, path, part)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table that `land_feeds` writes, which `decode` and `headers` take as well."""
    return spark.read.schema(_CHUNKS).parquet(path)


def decode(feeds: DataFrame, each: int = feed_parts.DEALT) -> DataFrame:
    """One row per vehicle entity of feed files or chunks; files are dealt out by `each` bytes a task."""
    ship_package(feeds.sparkSession)
    if "content" in feeds.columns:
        return feeds.select("content").mapInPandas(_decode_chunks, BRONZE["decoded_trains"])
    dealt = feed_parts.dealt(feeds.where("entities > 0").select("path", "start", "end"), each)
    return dealt.mapInPandas(_decode_parts, BRONZE["decoded_trains"])


def headers(feeds: DataFrame) -> DataFrame:
    """One row per feed file or poll: its path, header fields and number of entities; entities are not read.

    A chunk table gives its day as well. A message in pieces may repeat its header; the last
    value of a field counts, as for any reader of the whole message.
    """
    ship_package(feeds.sparkSession)
    if "content" in feeds.columns:
        keys, place = ["path", "dt"], F.lit(0)
        piece = F.when(F.col("entities") == 0, F.col("content"))
    else:
        keys, place = ["path"], F.col("start")
        piece = F.when(F.length("header") > 0, F.col("header"))
    pieces = F.collect_list(F.when(piece.isNotNull(), F.struct(place.alias("place"), piece.alias("piece"))))
    polls = feeds.groupBy(*keys).agg(F.sum("entities").cast("int").alias("entities"), F.array_sort(pieces).alias("pieces"))
    joined = polls.select(*keys, "entities", F.expr("aggregate(pieces, X'', (a, b) -> concat(a, b.piece))").alias("header"))

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [feed_message().FromString(bytes(content)).header for content in batch["header"]]
            yield batch[keys].assign(
                version=[h.gtfs_realtime_version for h in found],
                incrementality=[h.incrementality for h in found],
                header_at=[h.timestamp for h in found],
                entities=batch["entities"],
            )

    columns = "path string, " + ("dt date, " if "dt" in keys else "")
    return joined.mapInPandas(read, columns + "version string, incrementality int, header_at bigint, entities int")


def _field(message, path: str):
    """The value at a dotted path, or None where a step of it is absent."""
    for name in path.split("."):
        if not message.HasField(name):
            return None
        message = getattr(message, name)
    return message


def _set_field(message, path: str, value) -> None:
    *steps, last = path.split(".")
    for name in steps:
        message = getattr(message, name)
    setattr(message, last, value)


def _decode_chunks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _frames(bytes(content) for batch in batches for content in batch["content"])


def _decode_parts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _frames(feed_parts.read_part(*row) for batch in batches for row in batch.itertuples(index=False))


def _frames(messages: Iterable[bytes]) -> Iterator[pd.DataFrame]:
    read = [w for w in WIRE if w.column]
    columns = [part.split()[0] for part in BRONZE["decoded_trains"].split(", ")]

    def rows():
        for message in messages:
            feed = feed_message().FromString(message)
            for vehicle in (e.vehicle for e in feed.entity if e.HasField("vehicle")):
                yield {w.column: w.read(_field(vehicle, w.path)) for w in read}

    left = rows()
    while part := list(itertools.islice(left, BATCH)):
        frame = pd.DataFrame(part, columns=columns).astype({"heading": "Int32"})
        # The epoch holds local wall time written as if it were UTC; no zone is applied.
        frame["report_ts"] = pd.to_datetime(frame["report_ts"], unit="s")
        yield frame


def epoch_seconds(stamp: Column | str) -> Column:
    """Seconds of a naive local time read as if it were UTC, whatever the session zone."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    days = F.unix_date(stamp.cast("date")).cast("bigint")
    return days * 86_400 + F.hour(stamp) * 3_600 + F.minute(stamp) * 60 + F.second(stamp)


def feed_name(stamp: Column) -> Column:
    """trains_20240131T101500.pb"""
    return F.concat(F.lit("trains_"), F.date_format(stamp, "yyyyMMdd'T'HHmmss"), F.lit(".pb"))


def encode(trains: DataFrame, polls: DataFrame) -> DataFrame:
    """Chunks of feed files for polls: path below the feed root, day, entity count, bytes.

    `trains` is train rows with their poll's time in `feed_ts`; `polls` lists the polls to
    write (`feed_ts`). Serialised feed messages may be put one after the other: each poll
    has one chunk with its header, also without a usable train, and chunks of entities
    as tasks come by them. No task holds a poll, whatever its size. Trains without a
    position or outside the city are left out.
    """
    ship_package(trains.sparkSession)
    named = [feed_name(F.col("feed_ts")).alias("path"), F.to_date("feed_ts").alias("dt")]
    usable = trains.where(in_box("lat", "lon")).join(polls.distinct(), "feed_ts", "left_semi")
    usable = usable.withColumn("seen_at", epoch_seconds("tmstmp"))
    entities = usable.select(*named, *(w.source for w in WIRE)).mapInPandas(_encode_entities, _CHUNKS)
    headers = polls.distinct().select(*named, epoch_seconds("feed_ts").alias("header_at"))
    return headers.mapInPandas(_encode_headers, _CHUNKS).unionByName(entities)


def _encode_headers(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for polls in batches:
        content = []
        for at in polls["header_at"]:
            feed = feed_message()()
            header = {"gtfs_realtime_version": VERSION, "incrementality": FULL_DATASET, "timestamp": int(at)}
            for name, value in header.items():
                setattr(feed.header, name, value)
            content.append(feed.SerializeToString())
        yield polls[["path", "dt"]].assign(entities=0, content=content)


def _encode_entities(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for trains in batches:
        out = []
        for (path, day), rows in trains.groupby(["path", "dt"], sort=False):
            for at in range(0, len(rows), CHUNK):
                feed, some = feed_message()(), rows.iloc[at : at + CHUNK]
                for row in some[[w.source for w in WIRE]].to_dict("records"):
                    entity = feed.entity.add(id=_kept(row["rn"]) or "")
                    for wire in WIRE:
                        value = wire.write(row[wire.source])
                        if value is not None:
                            _set_field(entity.vehicle, wire.path, value)
                out.append((path, day, len(some), feed.SerializeToString()))
        yield pd.DataFrame(out, columns=["path", "dt", "entities", "content"])


def land_feeds(store: TableStore, name: str, chunks: DataFrame) -> int:
    """Write chunks as a table with a partition for each poll; the same poll again replaces its earlier load.

    A poll's chunks go wherever their rows are, the header as a row of its own, and a poll
    with a third of all rows takes several files and tasks. Polls appear when the whole job
    is committed, so a lost task leaves no part of one. Gives the number of chunks.
    """
    return store.reload_days(name, chunks, ("dt", "path"))


def write_feeds(chunks: DataFrame, root: str) -> DataFrame:
    """Write each poll's chunks to the single file `<root>/dt=<day>/<path>`, for readers that want one.

    Lazy, one row per file. The chunks of a poll come to one task in order, header first, which
    passes them on to the file one by one. A file gets its name once it is complete, and a
    second writer of the same poll leaves the same bytes.
    """
    ship_package(chunks.sparkSession)
    root = qualified(chunks.sparkSession, root)

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = open_folder(root)
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for (day, path), pieces in itertools.groupby(rows, key=lambda row: (row.dt, row.path)):
            folder = f"{base}/dt={day}"
            target.create_dir(folder, recursive=True)
            unfinished, entities = f"{folder}/.{path}.{uuid.uuid4().hex}.part", 0
            with target.open_output_stream(unfinished) as out:
                for piece in pieces:
                    out.write(piece.content)
                    entities += piece.entities
            target.move(unfinished, f"{folder}/{path}")
            yield pd.DataFrame({"path": [f"{folder}/{path}"], "entities": [entities]})

    in_order = chunks.repartition("dt", "path").sortWithinPartitions("dt", "path", F.col("entities") > 0, "content")
    return in_order.mapInPandas(write, "path string, entities int")


# A poll's time stands in its file's (or folder's) name.
_STAMP_IN_PATH = r"trains_(\d{8}T\d{6})[^/]*(?:/[^/]*)?$"
_STAMP = "yyyyMMdd'T'HHmmss"


def _poll_time(path: Column) -> Column:
    return F.to_timestamp_ntz(F.nullif(F.regexp_extract(path, _STAMP_IN_PATH, 1), F.lit("")), F.lit(_STAMP))


def _polls(spark: SparkSession, root: str, since: dt.date | None) -> DataFrame:
    """Polls by the names of what lies below a root; with a day, only folders of that day and later are listed."""
    under = [root] if since is None else [f"{root}/{d}" for d in folders(spark, root) if d >= f"dt={since}"]
    none = spark.createDataFrame([], "feed_ts timestamp_ntz")
    if not under or not any(folders(spark, u) or since for u in under):
        return none
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{parquet,pb}")
    paths = files.option("recursiveFileLookup", True).load(under).select("path")
    return paths.select(_poll_time(F.col("path")).alias("feed_ts")).where("feed_ts is not null").distinct()


def pending_polls(spark: SparkSession, poll_root: str, feed_root: str, since: dt.date | None = None) -> DataFrame:
    """Landed polls (Parquet named `trains_<stamp>`) that the chunk table, or a folder of feed files, lacks.

    Only file names are listed, so a poll without a single train counts too.
    """
    return _polls(spark, poll_root, since).join(_polls(spark, feed_root, since), "feed_ts", "left_anti")


def backfill(spark: SparkSession, poll_root: str, feed_root: str, since: dt.date | None = None) -> DataFrame:
    """Chunks for every landed poll that lacks them; a second run finds none."""
    polls = pending_polls(spark, poll_root, feed_root, since)
    files = spark.read.schema(BRONZE["train_positions"]).option("recursiveFileLookup", True).parquet(poll_root)
    rows = files.withColumn("feed_ts", _poll_time(F.col("_metadata.file_path")))
    return encode(rows.join(polls, "feed_ts", "left_semi"), polls)
