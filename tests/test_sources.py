from __future__ import annotations

import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from wayside.schemas import BRONZE
from wayside.sources import bus_feed, feed_parts, gtfs_rt, gtfs_static, landing, open_data, train_feed, weather
from wayside.storage import TableStore

AT = dt.datetime(2024, 6, 1, 12)


def at():
    return F.lit(AT).cast("timestamp_ntz")


def _lines(path, *documents):
    path.mkdir(parents=True, exist_ok=True)
    (path / "landed.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def _bus(spark, path):
    return bus_feed.conform(bus_feed.read_responses(spark, path), at())


def test_bus_responses(spark, tmp_path):
    full = {"vid": "8", "tmstmp": "20240131 23:59:58", "lat": "41.9", "lon": -87.6, "hdg": "90", "pid": 7,
            "rt": "66", "des": "Navy Pier", "pdist": 12, "dly": True, "zone": ""}
    bare = {"vid": "9", "tmstmp": "", "lat": "unknown", "hdg": "90.5", "zone": "A"}
    path = _lines(
        tmp_path,
        {"bustime-response": {"vehicle": [full, bare]}},
        {"bustime-response": {"error": [{"rt": "1", "msg": "No data found for parameter"}]}},
        {"bustime-response": {}},
    )
    first, second = _bus(spark, path).orderBy("vid").collect()
    assert (first.tmstmp, first.lat, first.lon, first.hdg, first.dly, first.zone) == (
        dt.datetime(2024, 1, 31, 23, 59, 58), 41.9, -87.6, 90, True, None)
    assert (second.tmstmp, second.lat, second.lon, second.hdg, second.dly, second.zone) == (
        None, None, None, None, False, "A")
    assert first._ingested_at == AT


@pytest.mark.parametrize("broken", ['{"bustime-response": {"vehicle": [{"vid": "1", "tmstmp": "2024-01-31"}]}}', '{"bustime'])
def test_bad_bus_response_stops_the_load(spark, tmp_path, broken):
    (tmp_path / "landed.json").write_text(broken)
    with pytest.raises(Exception):
        _bus(spark, str(tmp_path)).collect()


def test_train_responses_take_one_or_many(spark, tmp_path, rows):
    one = {"rn": "1", "prdt": "2024-01-01T10:00:00", "lat": "41.8", "lon": "-87.6", "heading": "12", "isApp": "1", "isDly": "0"}
    path = _lines(
        tmp_path,
        {"ctatt": {"route": [
            {"@name": "red", "train": one},
            {"@name": "blue", "train": [{**one, "rn": "2", "isDly": "1"}, {"rn": "3", "lat": "x", "prdt": ""}]},
            {"@name": "y"},
        ]}},
        {"ctatt": {}},
    )
    trains = train_feed.conform(train_feed.flatten(train_feed.read_responses(spark, path), at()))
    got = rows(trains, "rn", "rt", "lat", "isApp", "isDly", "tmstmp")
    ten = dt.datetime(2024, 1, 1, 10)
    assert got == [("1", "red", 41.8, True, False, ten), ("2", "blue", 41.8, True, True, ten),
                   ("3", "blue", None, False, False, None)]
    assert trains.dtypes == [tuple(f.split(" ")) for f in BRONZE["train_positions"].split(", ")]


def test_weather_arrays(spark, tmp_path, rows):
    daily = {"time": ["2024-01-01", "2024-01-02", "2024-01-03"]}
    daily |= {name: [1.0, None, 3.0] for name in weather.MEASURES}
    days = weather.conform(weather.read_responses(spark, _lines(tmp_path, {"daily": daily})), at())
    assert rows(weather.within(days, "2024-01-02", "2024-01-03"), "date", "rain_sum") == [
        (dt.date(2024, 1, 2), None), (dt.date(2024, 1, 3), 3.0)]


def test_open_data_drops_nested_points(spark, tmp_path):
    path = _lines(tmp_path, {"id": "1", "where": {"type": "Point", "coordinates": [1, 2]}, "n": "5"}, {"id": "2", "extra": "x"})
    table = open_data.scan(spark, path, at())
    assert sorted(table.columns) == ["_ingested_at", "extra", "id", "n"] and table.count() == 2


def test_congestion_slice_takes_all_and_pages(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(
        F.format_string("2018-01-%02dT00:00:00.000", (F.col("id") % 28 + 1).cast("int")).alias("time"),
        F.col("id").cast("string").alias("segment_id"),
    )
    old = rows.limit(3).withColumn("time", F.lit("2017-12-31T23:00:00.000"))
    taken = open_data.congestion_slice(rows.unionByName(old))
    assert taken.count() == 1000 and open_data.congestion_slice(rows.unionByName(old), None).count() == 1003
    monkeypatch.setattr(open_data, "PAGE_ROWS", 30)
    path = tmp_path / "pages"
    assert open_data.land_pages(taken, str(path)) == 1000
    assert spark.read.parquet(str(path)).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 30


def test_zip_set(spark, tmp_path, rows):
    with zipfile.ZipFile(tmp_path / "set.zip", "w") as archive:
        archive.writestr("stops.txt", '﻿stop_id,stop_name,stop_lat\r\n007,"Clark, ""N""\nside",41.9\r\n8,,\r\n')
        archive.writestr("readme.md", "not a table")
        archive.writestr("trips.txt", "trip_id\nt1\n")
    tables = gtfs_static.scan_zip(spark, str(tmp_path), at())
    assert sorted(tables) == ["stops", "trips"]
    assert rows(tables["stops"].drop("_ingested_at")) == [("007", 'Clark, "N"\nside', "41.9"), ("8", None, None)]
    assert rows(tables["trips"]) == [("t1", AT)]
    with zipfile.ZipFile(tmp_path / "other.zip", "w") as archive:
        archive.writestr("trips.txt", "id\nt2\n")
    with pytest.raises(ValueError, match="trips"):
        gtfs_static.scan_zip(spark, str(tmp_path), at())


def test_every_member_of_a_zip_is_a_task(spark, tmp_path):
    for name, members in (("a", ["stops", "trips", "shapes"]), ("b", ["stops", "trips"])):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for member in members:
                archive.writestr(f"{member}.txt", "id\n" + "".join(f"{name}{i}\n" for i in range(25_000)))
            archive.writestr("empty.txt", "")
    spark.dataSource.register(gtfs_static._zip_members())
    paths = json.dumps([f"file:{tmp_path}/a.zip", f"file:{tmp_path}/b.zip"])
    records = spark.read.format("zip_members").option("archives", paths).load()
    tasks = records.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("archive", "member").alias("members"), F.count("*").alias("n")).collect()
    assert len(tasks) == 5 and all((t["members"], t["n"]) == (1, 25_001) for t in tasks)
    tables = gtfs_static.scan_zip(spark, str(tmp_path), at())
    assert {name: t.count() for name, t in tables.items()} == {"stops": 50_000, "trips": 50_000, "shapes": 25_000}


def test_text_members_and_snapshots(spark, tmp_path, rows):
    folder = tmp_path / "set"
    folder.mkdir()
    (folder / "routes.txt").write_text("route_id,route_type\n007,3\n")
    (folder / "shapes.txt").write_text("shape_id\n1\n2\n")
    names = gtfs_static.members(spark, str(folder))
    assert names == ["routes", "shapes"]
    store = TableStore(spark, str(tmp_path / "bronze"))
    tables = {n: gtfs_static.scan_table(spark, str(folder), n, at()) for n in names}
    for day in (1, 2, 2):
        metrics = gtfs_static.land_static(spark, store, "cta", tables, dt.date(2026, 6, day))
    assert rows(metrics, "table_name", "row_count") == [("routes", 1), ("shapes", 2)]
    newest = landing.newest_snapshot(spark, store.path("cta/gtfs_static/routes"))
    assert rows(newest) == [("007", "3", AT)]
    assert store.read("cta/gtfs_static/shapes").count() == 4


def test_pages_follow_each_other_in_time(spark, tmp_path, monkeypatch):
    """Over all files in the order of their names, each of a page at most."""
    monkeypatch.setattr(open_data, "PAGE_ROWS", 20)
    rows = spark.range(500).repartition(7).select((F.col("id") % 97).cast("string").alias("time"), "id")
    assert open_data.land_pages(rows.withColumn("time", F.lpad("time", 3, "0")), str(tmp_path / "pages")) == 500
    files = sorted((tmp_path / "pages").glob("part-*.parquet"))
    times = [spark.read.parquet(str(f)).toPandas()["time"].tolist() for f in files]
    assert len(files) >= 25 and max(map(len, times)) <= 20
    assert sum(times, []) == sorted(sum(times, []))


def test_undeclared_fields_are_found_in_one_read(spark, tmp_path, rows):
    """Later pages bring new fields, other kinds and lists of records; objects go, lists stay."""
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.json").write_text('{"id": 1, "n": 1.5, "point": {"x": 1}, "mixed": 1, "odd name": true}\n\n')
    (pages / "b.json").write_text('[{"id": 2, "new": "late", "list": [1, 2]}, {"id": null, "mixed": "text", "list": null}]\nnot json\n')
    table = open_data.scan_found(spark, str(pages), at())
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert kinds == {"id": "bigint", "n": "double", "mixed": "string", "odd name": "boolean", "new": "string", "list": "array<bigint>", "_ingested_at": "timestamp_ntz"}
    assert rows(table, "id", "n", "mixed", "`odd name`", "new", "list") == rows(spark.createDataFrame(
        [(1, 1.5, "1", True, None, None), (2, None, None, None, "late", [1, 2]), (None, None, "text", None, None, None), (None,) * 6],
        "id long, n double, mixed string, o boolean, new string, list array<long>"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text("\n")
    assert open_data.scan_found(spark, str(tmp_path / "none"), at()).columns == ["_ingested_at"]


def test_newest_snapshot_without_any(spark, tmp_path):
    with pytest.raises(LookupError):
        landing.newest_snapshot(spark, str(tmp_path / "none"))


# --- GTFS-Realtime -------------------------------------------------------------

pytest.importorskip("google.protobuf")

POLL = dt.datetime(2024, 1, 31, 10, 15)
TRAIN = ("rn string, rt string, tmstmp timestamp_ntz, lat double, lon double, heading int, isApp boolean, "
         "isDly boolean, nextStpId string, feed_ts timestamp_ntz")


def _trains(spark, *rows):
    return spark.createDataFrame(list(rows), TRAIN)


def _polls(trains):
    return trains.select("feed_ts").distinct()


def test_feed_round_trip(spark, rows):
    seen = dt.datetime(2024, 1, 31, 10, 14, 30)
    trains = _trains(
        spark,
        ("1", "red", seen, 41.9, -87.6, 90, True, False, "30", POLL),
        ("2", "blue", None, 43.0, -89.0, None, False, True, "", POLL),
        ("3", "blue", seen, 0.0, 0.0, 1, False, False, "31", POLL),
        ("4", "blue", seen, None, -87.0, 1, False, False, "31", POLL),
    )
    feeds = gtfs_rt.encode(trains, _polls(trains))
    sums = feeds.groupBy("path", "dt").agg(F.sum("entities")).collect()
    assert [tuple(r) for r in sums] == [("trains_20240131T101500.pb", dt.date(2024, 1, 31), 2)]
    decoded = gtfs_rt.decode(feeds)
    assert [f.dataType.simpleString() for f in decoded.schema] == ["string", "string", "double", "double", "int", "boolean", "string", "timestamp_ntz"]
    first, second = decoded.orderBy("vehicle_id").collect()
    assert (first.route_id, first.heading, first.is_delayed, first.stop_id, first.report_ts) == ("red", 90, False, "30", seen)
    assert first.lat == pytest.approx(41.9, abs=1e-5) and first.lat != 41.9
    assert (second.heading, second.is_delayed, second.stop_id, second.report_ts) == (None, True, None, None)


def test_decoder_skips_other_entities(spark):
    message = gtfs_rt.feed_message()()
    message.header.gtfs_realtime_version = "2.0"
    message.entity.add(id="alert")
    vehicle = message.entity.add(id="v").vehicle
    vehicle.position.latitude = 41.5
    raw = spark.createDataFrame([(bytearray(message.SerializeToString()),), (bytearray(b""),)], "content binary")
    (row,) = gtfs_rt.decode(raw).collect()
    assert (row.vehicle_id, row.route_id, row.lat, row.lon, row.heading, row.report_ts) == (None, None, 41.5, 0.0, None, None)


def _many(spark, n):
    return spark.range(n).repartition(7).select(
        F.col("id").cast("string").alias("rn"), F.lit("red").alias("rt"), F.lit(POLL).cast("timestamp_ntz").alias("tmstmp"),
        F.lit(41.5).alias("lat"), F.lit(-87.5).alias("lon"), F.lit(1).alias("heading"), F.lit(True).alias("isApp"),
        F.lit(False).alias("isDly"), F.lit("1").alias("nextStpId"), F.lit(POLL).cast("timestamp_ntz").alias("feed_ts"))


def test_every_poll_is_one_file_with_one_header(spark, tmp_path, rows):
    many = _many(spark, 1000)
    idle = dt.datetime(2024, 1, 31, 10, 17)
    polls = _polls(many).unionByName(spark.createDataFrame([(idle,)], "feed_ts timestamp_ntz"))
    chunks = gtfs_rt.encode(many, polls)
    assert chunks.where("entities > 0").count() == 7
    written = gtfs_rt.write_feeds(chunks, str(tmp_path))
    assert rows(written, "entities") == [(0,), (1000,)]
    files = sorted(tmp_path.glob("dt=2024-01-31/*"))
    assert [f.name for f in files] == ["trains_20240131T101500.pb", "trains_20240131T101700.pb"]
    for file, at, n in zip(files, (POLL, idle), (1000, 0)):
        message = gtfs_rt.feed_message()()
        message.ParseFromString(file.read_bytes())
        assert message.header.timestamp == int(at.replace(tzinfo=dt.timezone.utc).timestamp())
        assert (message.header.gtfs_realtime_version, message.header.incrementality, len(message.entity)) == ("2.0", 0, n)
        # A reader that takes the last header of several would still find the same one.
        assert file.read_bytes().count(b"\x0a\x03" + b"2.0") == 1


def test_a_poll_whose_writer_is_lost_stays_pending(spark, tmp_path, rows):
    polls, root = tmp_path / "polls", tmp_path / "feeds"
    seen = dt.datetime(2024, 1, 31, 10)
    train = spark.createDataFrame(
        [("1", "red", seen, 41.9, -87.6, 90, None, None, None, None, "30", None, True, False, None, seen)], BRONZE["train_positions"])
    train.write.parquet(str(polls / "dt=2024-01-31" / "trains_20240131T100000.parquet"))
    root.mkdir()
    chunks = gtfs_rt.backfill(spark, str(polls), str(root))
    broken = chunks.withColumn("content", F.when(F.col("entities") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        gtfs_rt.write_feeds(broken, str(root)).collect()
    assert gtfs_rt.pending_polls(spark, str(polls), str(root)).count() == 1
    gtfs_rt.write_feeds(gtfs_rt.backfill(spark, str(polls), str(root)), str(root)).collect()
    assert gtfs_rt.pending_polls(spark, str(polls), str(root)).count() == 0


def test_backfill_is_idempotent(spark, tmp_path, rows):
    polls, root = tmp_path / "polls", tmp_path / "feeds"
    seen = dt.datetime(2024, 1, 31, 10)
    empty = spark.createDataFrame([], BRONZE["train_positions"])
    train = spark.createDataFrame(
        [("1", "red", seen, 41.9, -87.6, 90, None, None, None, None, "30", None, True, False, None, seen)], BRONZE["train_positions"])
    train.write.parquet(str(polls / "dt=2024-01-31" / "trains_20240131T100000.parquet"))
    empty.write.parquet(str(polls / "dt=2024-01-31" / "trains_20240131T100200.parquet"))
    root.mkdir()
    written = gtfs_rt.write_feeds(gtfs_rt.backfill(spark, str(polls), str(root)), str(root))
    assert rows(written, "entities") == [(0,), (1,)]
    assert sorted(p.name for p in root.glob("dt=*/*.pb")) == ["trains_20240131T100000.pb", "trains_20240131T100200.pb"]
    assert gtfs_rt.backfill(spark, str(polls), str(root)).count() == 0
    assert rows(gtfs_rt.decode(gtfs_rt.read_feeds(spark, str(root))), "vehicle_id", "report_ts") == [("1", seen)]


def _message(entities, **fields):
    message = gtfs_rt.feed_message()()
    message.header.gtfs_realtime_version = "2.0"
    message.header.timestamp = 7
    for i in range(entities):
        message.entity.add(id=f"e{i}").vehicle.vehicle.id = "v" * (i % 5) + str(i)
    return message.SerializeToString()


def test_a_feed_is_cut_between_entities_at_any_byte():
    """Blocks that end at every byte give the same fields, parts of every size the same entities in order."""
    raw = _message(12)
    whole = [e.vehicle.vehicle.id for e in gtfs_rt.feed_message().FromString(raw).entity]
    fields = list(feed_parts.outer_fields(io.BytesIO(raw), len(raw)))
    assert [f.number for f in fields] == [feed_parts.HEADER] + [feed_parts.ENTITY] * 12
    for size in range(1, len(raw) + 2):
        assert list(feed_parts.outer_fields(io.BytesIO(raw), len(raw), size)) == fields
        cut = list(feed_parts.parts(io.BytesIO(raw), len(raw), size, block=3))
        assert [cut[0][0], *[p[1] for p in cut]] == [0, *[p[0] for p in cut[1:]], len(raw)]
        assert all(b - a <= size or b - a in [f.end - f.start for f in fields] for a, b, *_ in cut)
        read = [gtfs_rt.feed_message().FromString(raw[a:b]) for a, b, *_ in cut]
        assert [e.vehicle.vehicle.id for m in read for e in m.entity] == whole
        assert [len(m.entity) for m in read] == [p[2] for p in cut] and b"".join(p[3] for p in cut) == raw[: fields[0].end]


def test_a_torn_feed_is_an_error_at_every_byte():
    raw = _message(3)
    ends = {f.end for f in feed_parts.outer_fields(io.BytesIO(raw), len(raw))} | {0}
    for size in range(len(raw)):
        if size in ends:
            assert sum(1 for _ in feed_parts.outer_fields(io.BytesIO(raw), size)) == sorted(ends).index(size)
        else:
            with pytest.raises(ValueError, match="ends inside"):
                list(feed_parts.outer_fields(io.BytesIO(raw), size))


def test_unknown_fields_are_passed_over(spark, tmp_path, rows):
    """Numbers, fixed values and bytes of other fields between the entities, and an empty file."""
    pieces = [_message(2), b"\x18\x96\x01", b"\x21" + b"\0" * 8, b"\x2d" + b"\0" * 4, b"\x32\x03abc", _message(1)]
    (tmp_path / "a.pb").write_bytes(b"".join(pieces))
    (tmp_path / "b.pb").write_bytes(b"")
    feeds = gtfs_rt.read_feeds(spark, str(tmp_path), part=20)
    assert rows(gtfs_rt.decode(feeds, each=30), "vehicle_id") == [("0",), ("0",), ("v1",)]
    assert rows(gtfs_rt.headers(feeds).drop("path")) == [("2.0", 0, 7, 3)]
    (tmp_path / "c.pb").write_bytes(_message(2)[:-1])
    with pytest.raises(Exception, match="c.pb: the file ends inside a message"):
        gtfs_rt.headers(gtfs_rt.read_feeds(spark, str(tmp_path))).collect()


def test_a_hot_poll_is_read_by_many_tasks(spark, tmp_path, rows):
    many = _many(spark, 3000)
    gtfs_rt.write_feeds(gtfs_rt.encode(many, _polls(many)), str(tmp_path)).collect()
    decoded = gtfs_rt.decode(gtfs_rt.read_feeds(spark, str(tmp_path), part=2_000), each=20_000)
    tasks = decoded.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 5 and max(t["count"] for t in tasks) < 1000
    assert rows(decoded.agg(F.count("vehicle_id"), F.countDistinct("vehicle_id"))) == [(3000, 3000)]


def test_a_hot_poll_is_split_among_a_clusters_reducers(spark, tmp_path):
    """Over 2,000 reducers sizes are reported as means, which hid the hot one."""
    store = TableStore(spark, str(tmp_path))
    small, many_keys = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in (small, many_keys)}
    spark.conf.set(small, "20k")
    spark.conf.set(many_keys, "3000")
    try:
        many = _many(spark, 4000)
        gtfs_rt.land_feeds(store, "trains", gtfs_rt.encode(many, _polls(many)))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(list(tmp_path.glob("trains/dt=2024-01-31/path=trains_20240131T101500.pb/*.parquet"))) > 2


def test_chunks_of_a_poll_go_to_many_files(spark, tmp_path, rows):
    """A hot poll is split, has one header row, and landing it again replaces it."""
    store = TableStore(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        for _ in range(2):
            many = _many(spark, 4000)
            gtfs_rt.land_feeds(store, "trains", gtfs_rt.encode(many, _polls(many)))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list(tmp_path.glob("trains/dt=2024-01-31/path=trains_20240131T101500.pb/*.parquet"))) > 2
    chunks = gtfs_rt.read_chunks(spark, store.path("trains"))
    assert chunks.where("entities = 0").count() == 1 and chunks.agg(F.max("entities")).first()[0] <= gtfs_rt.CHUNK
    assert rows(gtfs_rt.headers(chunks)) == [("trains_20240131T101500.pb", dt.date(2024, 1, 31), "2.0", 0, 1706696100, 4000)]
    assert gtfs_rt.decode(chunks).agg(F.countDistinct("vehicle_id")).first()[0] == 4000


def test_a_lost_task_leaves_no_part_of_a_poll(spark, tmp_path, rows):
    polls = tmp_path / "polls"
    seen = dt.datetime(2024, 1, 31, 10)
    train = spark.createDataFrame(
        [("1", "red", seen, 41.9, -87.6, 90, None, None, None, None, "30", None, True, False, None, seen)], BRONZE["train_positions"])
    train.write.parquet(str(polls / "dt=2024-01-31" / "trains_20240131T100000.parquet"))
    train.write.parquet(str(polls / "dt=2024-02-01" / "trains_20240201T100000.parquet"))
    store = TableStore(spark, str(tmp_path / "out"))
    chunks = gtfs_rt.backfill(spark, str(polls), store.path("trains"))
    broken = chunks.withColumn("content", F.when(F.col("entities") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        gtfs_rt.land_feeds(store, "trains", broken)
    assert gtfs_rt.pending_polls(spark, str(polls), store.path("trains")).count() == 2
    late = gtfs_rt.backfill(spark, str(polls), store.path("trains"), since=dt.date(2024, 2, 1))
    gtfs_rt.land_feeds(store, "trains", late)
    assert rows(gtfs_rt.pending_polls(spark, str(polls), store.path("trains"))) == [(seen,)]
    for left in (2, 0):
        assert gtfs_rt.land_feeds(store, "trains", gtfs_rt.backfill(spark, str(polls), store.path("trains"))) == left
    assert gtfs_rt.read_chunks(spark, store.path("trains")).where("entities > 0").count() == 2


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark, tmp_path):
    from wayside import storage

    assert storage.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    with pytest.raises(ValueError, match="no file system"):
        storage.open_folder(str(tmp_path))
    conf, key = spark._jsc.hadoopConfiguration(), "fs.defaultFS"
    before = conf.get(key)
    conf.set(key, "viewfs://lake")
    conf.set("fs.viewfs.mounttable.lake.link./in", f"file:{tmp_path}")
    try:
        assert storage.qualified(spark, "/in/a") == "viewfs://lake/in/a"
        storage.make_folder(spark, "/in/a/dt=2024-01-01")
        assert storage.folders(spark, "/in/a") == ["dt=2024-01-01"]
    finally:
        conf.set(key, before)
    assert (tmp_path / "a" / "dt=2024-01-01").is_dir()
