from __future__ import annotations

import datetime as dt
import hashlib

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wayside.functions import boxes, calendar, casts, keys, picking, ranking


def _texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def test_lenient_casts(spark):
    texts = ["2.7", " 7 ", "", "abc", "1e3", "-2.5", "2.5", "99999999999", "NaN", "inf", "true", None, "1.5d", "2f"]
    got = _texts(spark, texts).select(casts.conform_int("t"), casts.conform_double("t")).collect()
    assert [r[0] for r in got] == [3, 7, None, None, 1000, -3, 3, None, None, None, None, None, None, None]
    doubles = [r[1] for r in got]
    assert doubles[:8] == [2.7, 7.0, None, None, 1000.0, -2.5, 2.5, 99999999999.0]
    assert doubles[8] != doubles[8] and doubles[9] == float("inf")
    assert doubles[10:] == [None] * 4


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"\A ?-?[0-9]{0,6}(\.[0-9]{0,4})?(e[0-9])? ?\Z"), min_size=20, max_size=60))
def test_conform_int_agrees_with_sql(spark, values):
    got = [r[0] for r in _texts(spark, values).orderBy("i").select(casts.conform_int("t")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT try_cast(? AS INTEGER)", [v]).fetchone()[0] for v in values]
    assert got == want


def test_clock_seconds_past_midnight(spark):
    got = _texts(spark, ["25:03:10", "00:00:00", None]).orderBy("i").select(casts.clock_seconds("t")).collect()
    assert [r[0] for r in got] == [25 * 3600 + 190, 0, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "convert, bad",
    [
        (casts.clock_seconds, ""),
        (casts.clock_seconds, "10:xx:00"),
        (casts.strict_bigint, "abc"),
        (casts.strict_timestamp, "yesterday"),
        (lambda c: casts.strict_timestamp(c, "yyyyMMdd HH:mm:ss"), "2024-01-01"),
    ],
)
def test_strict_casts_stop_the_job_in_any_session(spark, convert, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            _texts(spark, [bad]).select(convert("t")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_strict_timestamp_accepts_nothing_as_null(spark):
    got = _texts(spark, ["", None, "2024-03-10T02:30:00"]).orderBy("i").select(casts.strict_timestamp("t")).collect()
    assert [r[0] for r in got] == [None, None, dt.datetime(2024, 3, 10, 2, 30)]


def test_surrogate_key_separates_items(spark):
    row = spark.range(1).select(
        F.lit("a").alias("x"), F.lit(None).cast("string").alias("y"), F.lit(dt.datetime(2024, 1, 1, 5)).cast("timestamp_ntz").alias("z")
    ).select(keys.surrogate_key("x", "y", "z"), keys.surrogate_key("x")).first()
    assert row[0] == hashlib.md5(b"a||_null_||2024-01-01 05:00:00").hexdigest()
    assert row[1] == hashlib.md5(b"a").hexdigest()


def test_calendar(spark):
    days = calendar.day_spine(spark, "2024-02-28", "2024-03-03")
    got = days.select(
        keys.date_key("date_day"), calendar.sunday_zero(F.col("date_day")), calendar.day_name(F.col("date_day"))
    ).collect()
    assert [tuple(r) for r in got] == [
        (20240228, 3, "Wednesday"),
        (20240229, 4, "Thursday"),
        (20240301, 5, "Friday"),
        (20240302, 6, "Saturday"),
        (20240303, 0, "Sunday"),
    ]


def test_box_includes_its_edges(spark):
    places = [(41.0, -89.0), (43.0, -87.0), (40.99, -88.0), (42.0, -86.99), (None, -88.0)]
    got = spark.createDataFrame(places, "lat double, lon double").select(boxes.in_box("lat", "lon")).collect()
    assert [r[0] for r in got] == [True, True, False, False, None]


def test_keep_first_orders_nulls_last_and_groups_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, 5, "late"), (1, 3, "early"), (None, 2, "b"), (None, 2, "a")], "k int, o int, v string"
    )
    assert rows(picking.keep_first(df, ["k"], by=["o"])) == [(1, 3, "early"), (None, 2, "a")]
    assert rows(picking.keep_first(df, ["k"], by=["o"], descending=["o"])) == [(1, 5, "late"), (None, 2, "a")]


def test_keep_first_is_independent_of_partitioning(spark, rows):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("o"), F.xxhash64("id").alias("payload")
    )
    once = rows(picking.keep_first(df.repartition(1), ["k"], by=["o"]))
    assert once == rows(picking.keep_first(df.repartition(13), ["k"], by=["o"]))
    assert len(once) == 7


def test_global_rank_matches_window_rank(spark):
    # A third of the rows share one value; some have none.
    value = F.when(F.col("id") % 3 == 0, 10.0).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 400) / 7.0)
    df = spark.range(6000).select("id", value.alias("v"))
    ranked = ranking.global_rank(df, "v", "r")
    ranked.createOrReplaceTempView("ranked_rows")
    wrong = spark.sql(
        "SELECT count(*) FROM (SELECT r, rank() OVER (ORDER BY v ASC NULLS LAST) AS w FROM ranked_rows) WHERE r <> w"
    ).first()[0]
    assert wrong == 0 and ranked.count() == 6000


def test_keep_first_with_keys_only(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(picking.keep_first(df, ["k"])) == [(1,), (None,)]
