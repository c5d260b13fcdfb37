from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from wayside.operators import intermediate, quality, staging
from wayside.operators.silver import earliest_reports
from wayside.schemas import SILVER, struct
from wayside.storage import TableStore
from wayside.streaming import feeds, positions, states

T0 = dt.datetime(2024, 1, 1, 8)


def _report(vehicle, minute, route="66", lat=41.9, late=False, seen=0):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return ("CTA", "bus", vehicle, route, None, lat, -87.6, 0, late, at, (at or T0) + dt.timedelta(seconds=seen))


def _land(spark, root, *reports):
    spark.createDataFrame(list(reports), SILVER["silver_vehicle_positions"]).coalesce(1).write.mode("append").parquet(root)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "in"), TableStore(None, str(tmp_path / "out")), str(tmp_path / "progress")


def _drain(spark, folders, handle, shape=lambda s: s, mode="append"):
    root, store, progress = folders
    store.spark = spark
    positions.start(shape(positions.positions_stream(spark, root)), handle, progress, mode=mode).awaitTermination()


def test_new_files_are_picked_up_once(spark, folders, rows):
    root, store, _ = folders
    land = positions.append_to(store, "bus")
    _land(spark, root, _report("1", 0))
    _drain(spark, folders, land)
    _land(spark, root, _report("2", 1), _report("3", 1))
    _drain(spark, folders, land)
    assert rows(store.read("bus"), "vehicle_id", "batch") == [("1", 0), ("2", 1), ("3", 1)]


def test_dedupe_across_batches(spark, folders, rows):
    root, store, _ = folders
    land = positions.append_to(store, "bus")
    _land(spark, root, _report("1", 0), _report("1", 0, seen=9), _report("2", 0))
    _drain(spark, folders, land, positions.first_reports)
    _land(spark, root, _report("1", 0, seen=120), _report("1", 2))
    _drain(spark, folders, land, positions.first_reports)
    assert rows(store.read("bus"), "vehicle_id", "report_ts") == [
        ("1", T0), ("1", T0 + dt.timedelta(minutes=2)), ("2", T0)]


@pytest.mark.parametrize("by", [positions.BY_HOUR, positions.BY_DAY])
def test_hourly_delay_includes_late_reports(spark, folders, rows, by):
    root, store, _ = folders
    routes = spark.createDataFrame([("66", "Chicago")], "route_id string, route_long_name string")
    handle = positions.hourly_delay_exact(store, routes, by)
    batches = [
        [_report("1", 0, late=True), _report("2", 5), _report("1", 70)],
        [_report("3", 150, route="99"), _report("5", None)],
        [_report("4", 10), _report("1", 0, seen=-30), _report("2", 5)],
    ]
    for batch in batches:
        _land(spark, root, *batch)
        _drain(spark, folders, handle)
    silver = spark.createDataFrame([r for b in batches for r in b], SILVER["silver_vehicle_positions"])
    staged = staging.vehicle_positions(earliest_reports(silver))
    expected = intermediate.delay_by_route_hour(intermediate.vehicle_hours(staged), routes)
    assert rows(store.read("hourly"), *expected.columns) == rows(expected)


def test_fleet_keeps_the_newest_whatever_the_order(spark, folders, rows):
    root, store, _ = folders
    handle = positions.latest_fleet(store)
    for batch in ([_report("1", 10), _report("2", 0)], [_report("1", 5), _report("2", 20, seen=3), _report("2", 20)], [_report("3", 1)]):
        _land(spark, root, *batch)
        _drain(spark, folders, handle)
    fleet = positions.fleet(store)
    assert rows(fleet, "vehicle_id", "report_ts", "_ingested_at") == [
        (v, T0 + dt.timedelta(minutes=m), T0 + dt.timedelta(minutes=m)) for v, m in (("1", 10), ("2", 20), ("3", 1))]


def test_repeated_batch_changes_nothing(spark, folders, rows):
    root, store, _ = folders
    store.spark = spark
    handle = positions.latest_fleet(store)
    batch = spark.createDataFrame([_report("1", 10)], SILVER["silver_vehicle_positions"])
    later = spark.createDataFrame([_report("1", 12), _report("2", 1)], SILVER["silver_vehicle_positions"])
    for batch_id, frame in ((0, batch), (1, later), (1, later)):
        handle(frame, batch_id)
    assert rows(positions.fleet(store), "vehicle_id") == [("1",), ("2",)]


def test_a_new_checkpoint_goes_on_from_the_fleet(spark, folders, rows):
    """Batch numbers start at nothing again; the newest reports stay."""
    root, store, _ = folders
    store.spark = spark
    for minute in (10, 30, 20):
        frame = spark.createDataFrame([_report("1", minute)], SILVER["silver_vehicle_positions"])
        positions.latest_fleet(store)(frame, 0)
    newest = positions.fleet(store).collect()
    assert [(r["vehicle_id"], r["report_ts"]) for r in newest] == [("1", T0 + dt.timedelta(minutes=30))]


def test_gate_quarantines_rows(spark, folders, rows):
    root, store, _ = folders
    checks = [quality.Expectation(quality.NOT_NULL, "vehicle_id"), quality.Expectation(quality.BETWEEN, "lat", 41, 43)]
    _land(spark, root, _report("1", 0), _report("2", 0, lat=0.0), _report(None, 0), _report("4", 0, lat=None))
    _drain(spark, folders, positions.gated(store, "live", checks))
    assert rows(store.read("accepted"), "vehicle_id") == [("1",), ("4",)]
    assert rows(store.read("quarantine"), "vehicle_id") == [("2",), (None,)]
    assert rows(store.read("checks"), "position", "unexpected", "success") == [(1, 1, False), (2, 1, False)]


def _feed(spark, root, progress, name, handle):
    return lambda: positions.start(positions.positions_stream(spark, root), handle, f"{progress}-{name}")


def test_a_run_over_what_is_there_raises_when_the_others_have_ended(spark, folders):
    root, store, progress = folders
    store.spark = spark
    _land(spark, root, _report("1", 0))

    def broken(batch, batch_id):
        raise RuntimeError("feed down")

    with pytest.raises(Exception, match="feed down"):
        feeds.run_feeds({
            "bad": _feed(spark, root, progress, "bad", broken),
            "good": _feed(spark, root, progress, "good", positions.append_to(store, "good")),
        })
    assert store.read("good").count() == 1


def test_a_lasting_feed_outlives_many_failures(spark, folders):
    root, store, progress = folders
    store.spark = spark
    _land(spark, root, _report("1", 0))
    land, tries, told = positions.append_to(store, "bad"), [], []

    def flaky(batch, batch_id):
        tries.append(batch_id)
        if len(tries) <= 10:
            raise RuntimeError(f"down {len(tries)}")
        land(batch, batch_id)

    feeds.run_feeds(
        {
            "bad": _feed(spark, root, progress, "bad", flaky),
            "good": _feed(spark, root, progress, "good", positions.append_to(store, "good")),
        },
        lasting=True, report=lambda name, error: told.append((name, str(error))), delay=0.0,
    )
    assert [name for name, _ in told] == ["bad"] * 10
    assert all(f"down {i}" in text for i, (_, text) in enumerate(told, 1))
    assert store.read("good").count() == store.read("bad").count() == 1


# --- keyed state


def _shuffled(seed, n=90):
    """Reports of few vehicles, routes and minutes, many of them of one key; ingested in another order than they come."""
    draw = random.Random(seed)
    return [
        _report(draw.choice(["1", "2", "3", None]), draw.choice([None, 0, 5, 70, 1500]), draw.choice(["66", "99"]), late=draw.random() < 0.4, seen=draw.randrange(-50, 50))
        for _ in range(n)
    ]


def _batches(spark, folders, shape, handle, reports, parts=3):
    """Every batch is a run of its own, so that each but the first starts again from the checkpoint."""
    root, _, _ = folders
    for i in range(parts):
        _land(spark, root, *reports[i::parts])
        _drain(spark, folders, handle, shape, mode="update")


def _silver(spark, reports):
    return spark.createDataFrame(reports, SILVER["silver_vehicle_positions"])


def test_fleet_state_writes_changed_vehicles_only(spark, folders, rows):
    root, store, progress = folders
    reports = _shuffled(1)
    _batches(spark, folders, states.fleet_changes, states.log_to(store, "fleet_log"), reports)
    wanted = rows(positions.newest_per_vehicle(_silver(spark, reports)))
    assert rows(states.fleet(store).select(*_silver(spark, reports).columns)) == wanted
    before = store.read("fleet_log").count()
    _land(spark, root, _report("2", 2000), _report("1", 1))
    _drain(spark, folders, states.log_to(store, "fleet_log"), states.fleet_changes, mode="update")
    assert store.read("fleet_log").count() == before + 1
    newest = rows(states.fleet(store))
    assert states.compact_fleet(store) == 4 and not store.exists("fleet_log/batch=0")
    # A new checkpoint reads everything again, beside the compacted table.
    again = root, store, f"{progress}-again"
    _drain(spark, again, states.log_to(store, "fleet_log"), states.fleet_changes, mode="update")
    assert rows(states.fleet(store)) == newest


def test_earliest_reports_in_any_order(spark, folders, rows):
    """Payload and all, after restarts; corrected days are settled into a target by day."""
    _, store, _ = folders
    reports = _shuffled(2)
    _batches(spark, folders, lambda s: states.earliest_changes(s).withColumn("report_date", F.to_date("report_ts")), states.log_to(store, "reports_log", "report_date"), reports)
    columns = _silver(spark, reports).columns
    wanted = earliest_reports(_silver(spark, reports)).select(*columns)
    assert rows(states.earliest(store).select(*columns)) == rows(wanted)
    log = store.read("reports_log")
    assert log.where("corrects").count() > 0 and log.where("not corrects").count() == wanted.count()
    days = [T0.date(), T0.date() + dt.timedelta(days=1)]
    for some in (days[:1], days[1:], days):
        states.settle_days(store, some, "positions")
    assert rows(store.read("positions").select(*columns)) == rows(wanted.where("report_ts is not null"))


def test_hourly_bitmaps_merge_late_reports(spark, folders, rows):
    _, store, _ = folders
    routes = spark.createDataFrame([("66", "Chicago")], "route_id string, route_long_name string")
    reports = _shuffled(3)
    _batches(spark, folders, states.earliest_changes, states.hourly_bitmaps(store), reports)
    staged = staging.vehicle_positions(earliest_reports(_silver(spark, reports)))
    expected = intermediate.delay_by_route_hour(intermediate.vehicle_hours(staged), routes)
    assert rows(states.hourly(store, routes), *expected.columns) == rows(expected)
    one_day = expected.where(F.col("report_date") == T0.date())
    assert rows(states.hourly(store, routes, [T0.date()]), *expected.columns) == rows(one_day)
    assert store.read("hour_parts").where("left").count() > 0


def test_a_repeated_batch_of_bitmaps_changes_nothing(spark, folders, rows):
    _, store, _ = folders
    store.spark = spark
    routes = spark.createDataFrame([], "route_id string, route_long_name string")
    told = {"corrects": F.lit(False), "old_agency": F.lit(None).cast("string"), "old_route_id": F.lit(None).cast("string"), "old_is_delayed": F.lit(None).cast("boolean")}
    first, second = (_silver(spark, r).withColumns(told) for r in ([_report("1", 0), _report("2", 5)], [_report("3", 5), _report("1", 9, late=True), _report("2", 90)]))
    handle = states.hourly_bitmaps(store)
    for batch_id, frame in ((0, first), (1, second), (1, second)):
        handle(frame, batch_id)
    assert rows(states.hourly(store, routes), "report_hour", "report_count", "delayed_count", "active_vehicles") == [(8, 4, 1, 3), (9, 1, 0, 1)]
    assert rows(store.read("vehicles"), "vehicle_id", "number") == [("1", 1), ("2", 2), ("3", 3)]


def test_state_of_silent_vehicles_goes(spark, folders, rows):
    """A query at a cadence lets state go after a while; the log's order keeps the fleet right."""
    root, store, progress = folders
    store.spark = spark
    _land(spark, root, _report("1", 10))
    changes = states.fleet_changes(positions.positions_stream(spark, root), lasts_days=1 / 86_400)
    ddl = SILVER["silver_vehicle_positions"] + ", run string, batch bigint"
    query = positions.start(changes, states.log_to(store, "fleet_log"), progress, "2 seconds", "update")
    try:
        for minute, least in ((10, 1), (5, 2)):
            if least > 1:
                _land(spark, root, _report("1", minute))
            until = time.monotonic() + 60
            while time.monotonic() < until and not (store.exists("fleet_log") and store.read("fleet_log", struct(ddl)).count() >= least):
                time.sleep(1)
            time.sleep(2)
    finally:
        query.stop()
    assert store.read("fleet_log").count() == 2
    assert rows(states.fleet(store), "report_ts") == [(T0 + dt.timedelta(minutes=10),)]


def test_runs_over_what_is_there_keep_first_rows_without_python(spark, folders):
    """A Python call for each key made a run over history take hours; state that expires still needs it."""
    root, _, _ = folders
    _land(spark, root, _report("1", 0))
    stream = positions.positions_stream(spark, root)
    for changes in (states.fleet_changes, states.earliest_changes):
        plans = [changes(stream, lasts)._jdf.queryExecution().analyzed().toString() for lasts in (None, 7)]
        assert ["TransformWithState" in p for p in plans] == [False, True]


def test_each_correction_takes_back_the_one_before(spark, folders, rows):
    """Of four reports under one key, each ingested before the last, also without a time; a repeated one changes nothing."""
    _, store, _ = folders
    steps = [("66", True, 40), ("99", False, 30), ("66", True, 20), ("66", False, 10), ("66", False, 10), ("99", True, 30)]
    reports = [_report(v, m, route=r, late=late, seen=seen) for r, late, seen in steps for v, m in (("1", 5), (None, None), ("2", 5))]
    routes = spark.createDataFrame([("66", "Chicago")], "route_id string, route_long_name string")
    root = folders[0]
    for i in range(0, len(reports), 3):
        _land(spark, root, *reports[i : i + 3])
        _drain(spark, folders, states.hourly_bitmaps(store), states.earliest_changes, mode="update")
    log = store.read("reports_log").where("vehicle_id = '1'").orderBy("batch")
    assert [tuple(r) for r in log.select("corrects", "route_id", "old_route_id", "old_is_delayed").collect()] == [
        (False, "66", None, None), (True, "99", "66", True), (True, "66", "99", False), (True, "66", "66", True)]
    assert store.read("reports_log").count() == 12
    staged = staging.vehicle_positions(earliest_reports(_silver(spark, reports)))
    expected = intermediate.delay_by_route_hour(intermediate.vehicle_hours(staged), routes)
    assert rows(states.hourly(store, routes), *expected.columns) == rows(expected)


def test_new_vehicles_are_numbered_by_few_tasks(spark, folders):
    """A cluster's shuffles start with many reducers; a batch's few vehicles are not written by all of them."""
    _, store, _ = folders
    store.spark = spark
    key, tracker = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.sparkContext.statusTracker()
    told = {"corrects": F.lit(False), **{f"old_{c}": F.lit(None).cast(k) for c, k in (("agency", "string"), ("route_id", "string"), ("is_delayed", "boolean"))}}
    spark.conf.set(key, "300")
    spark.sparkContext.setJobGroup("numbering", "a batch of bitmaps")
    try:
        states.hourly_bitmaps(store)(_silver(spark, [_report("1", 0), _report("2", 5)]).withColumns(told), 0)
    finally:
        spark.conf.unset(key)
        spark.sparkContext.setJobGroup("", "")
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("numbering") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 300
