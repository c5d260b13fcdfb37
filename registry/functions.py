"""Scalar, aggregate and window functions on whole tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from registry import query
from registry.inputs import Landed, given, hour_start, rounded, text
from registry.parts import compose, md5_of
from wayside.functions import calendar, casts, keys, picking
from wayside.operators import intermediate, staging
from wayside.sources.bus_feed import STAMP


@query("fn_01_surrogate_key", f"""
SELECT event_id, {md5_of('user_id', 'flag', 'ts')} AS three_sk, {md5_of('user_id')} AS one_sk
FROM (SELECT *, CASE WHEN event_id % 3 > 0 THEN event_type END AS flag FROM events)
""")
def surrogate_keys(spark, sf_dir):
    rows = given(spark, sf_dir, "events").withColumn("flag", F.when(F.col("event_id") % 3 > 0, F.col("event_type")))
    return rows.select(
        "event_id",
        keys.surrogate_key("user_id", "flag", "ts").alias("three_sk"),
        keys.surrogate_key("user_id").alias("one_sk"),
    )


_TEXTS = ["{n}", " {n} ", "{n}.5", "-{n}.5", "{n}e2", "{n}.49", "", "abc", "{n}x", "true", "99999999999", "{n}."]


@query("fn_02_try_cast", """
SELECT event_id, raw, try_cast(raw AS INTEGER) AS as_int, try_cast(raw AS DOUBLE) AS as_double FROM (
  SELECT event_id, replace([{texts}][event_id % {n} + 1], '{{n}}', (event_id % 500)::VARCHAR) AS raw FROM events)
""".format(texts=", ".join(f"'{t}'" for t in _TEXTS), n=len(_TEXTS)))
def lenient_casts(spark, sf_dir):
    pattern = F.element_at(F.array(*map(F.lit, _TEXTS)), (F.col("event_id") % len(_TEXTS) + 1).cast("int"))
    raw = F.replace(pattern, F.lit("{n}"), text(F.col("event_id") % 500))
    rows = given(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("*", casts.conform_int("raw").alias("as_int"), casts.conform_double("raw").alias("as_double"))


@query("fn_03_split_part", compose("""
SELECT trip_id, stop_id, arrival_time, split_part(arrival_time, ':', 1) AS hours, split_part(arrival_time, ':', 2) AS minutes,
       split_part(arrival_time, ':', 4) AS beyond
FROM x_stop_times
"""))
def clock_parts(spark, sf_dir):
    part = lambda i: F.split_part("arrival_time", F.lit(":"), F.lit(i))
    return Landed(spark, sf_dir)["stop_times"].select(
        "trip_id", "stop_id", "arrival_time", part(1).alias("hours"), part(2).alias("minutes"), part(4).alias("beyond")
    )


@query("fn_04_integer_division", compose("""
SELECT trip_id, stop_id, arrival_sec, arrival_sec // 3600 AS whole_hours, (arrival_sec // 3600) % 24 AS clock_hour
FROM x_silver_stop_times
"""))
def clock_hours(spark, sf_dir):
    seconds = casts.clock_seconds("arrival_time").alias("arrival_sec")
    rows = Landed(spark, sf_dir)["stop_times"].select("trip_id", "stop_id", seconds)
    return rows.select(
        "*", F.expr("arrival_sec div 3600 as whole_hours"), F.expr("(arrival_sec div 3600) % 24 as clock_hour")
    )


@query("fn_05_date_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key FROM orders")
def order_date_keys(spark, sf_dir):
    return given(spark, sf_dir, "orders").select("o_orderkey", keys.date_key("o_orderdate").alias("date_key"))


@query("fn_06_date_parts", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter,
       month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day, hour(o_orderdate)::INTEGER AS hour,
       week(o_orderdate)::INTEGER AS week
FROM orders
""")
def date_parts(spark, sf_dir):
    day = F.col("o_orderdate")
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.hour(day).alias("hour"),
        F.weekofyear(day).alias("week"),
    )


@query("fn_07_day_of_week", "SELECT o_orderkey, extract(dow FROM o_orderdate)::INTEGER AS day_of_week FROM orders")
def weekdays(spark, sf_dir):
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", calendar.sunday_zero(F.col("o_orderdate")).alias("day_of_week")
    )


@query("fn_08_names", "SELECT o_orderkey, monthname(o_orderdate) AS month, dayname(o_orderdate) AS day FROM orders")
def calendar_names(spark, sf_dir):
    day = F.col("o_orderdate")
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", calendar.month_name(day).alias("month"), calendar.day_name(day).alias("day")
    )


@query("fn_09_series", """
SELECT o_orderkey, unnest(generate_series(o_orderdate::DATE, o_orderdate::DATE + (o_orderkey % 5)::INTEGER,
                                          INTERVAL 1 DAY))::DATE AS day
FROM orders
""")
def order_days(spark, sf_dir):
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_orderkey") % 5).cast("int"))
    days = F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    return given(spark, sf_dir, "orders").select("o_orderkey", days.alias("day"))


@query("fn_10_coalesce_nullif", """
SELECT event_id, coalesce(nullif(event_type, 'click'), 'none') AS kind, value / nullif(event_id % 4, 0) AS share FROM events
""")
def null_handling(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(F.nullif("event_type", F.lit("click")), F.lit("none")).alias("kind"),
        (F.col("value") / F.nullif(F.col("event_id") % 4, F.lit(0).cast("bigint"))).alias("share"),
    )


@query("fn_11_greatest", """
SELECT event_id, greatest(0.0::DOUBLE, 1 - value / 30) AS slowdown, greatest(CASE WHEN event_id % 2 = 0 THEN value END, 5) AS floored
FROM events
""")
def clamps(spark, sf_dir):
    value = F.col("value")
    return given(spark, sf_dir, "events").select(
        "event_id",
        F.greatest(F.lit(0.0), F.lit(1.0) - value / 30).alias("slowdown"),
        F.greatest(F.when(F.col("event_id") % 2 == 0, value), F.lit(5.0)).alias("floored"),
    )


@query("fn_12_case", """
SELECT p_key, kind, CASE kind WHEN 0 THEN 'tram' WHEN 1 THEN 'subway' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus' ELSE 'other' END AS kind_name,
       (kind = 3) IS TRUE AS is_bus
FROM (SELECT o_orderkey AS p_key, nullif(o_orderkey % 6, 5)::INTEGER AS kind FROM orders)
""")
def route_kinds(spark, sf_dir):
    kind = F.nullif(F.col("o_orderkey") % 6, F.lit(5).cast("bigint")).cast("int")
    rows = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("route_id"), "o_orderkey", kind.alias("route_type")
    )
    blank = [F.lit(None).cast("string").alias(c) for c in
             ("agency", "route_short_name", "route_long_name", "route_color", "route_text_color")]
    named = staging.routes(rows.select("*", *blank))
    return named.select(
        F.col("route_id").cast("bigint").alias("p_key"),
        F.col("route_type").alias("kind"),
        F.col("route_type_name").alias("kind_name"),
        F.coalesce(F.col("route_type") == 3, F.lit(False)).alias("is_bus"),
    )


@query("fn_13_predicates", """
SELECT event_id FROM events
WHERE value >= 2 AND value <= 20 AND event_type NOT IN ('click', 'view') AND props IS NOT NULL
""")
def predicates(spark, sf_dir):
    return given(spark, sf_dir, "events").where(
        F.col("value").between(2, 20) & ~F.col("event_type").isin("click", "view") & F.col("props").isNotNull()
    ).select("event_id")


@query("fn_14_time_arithmetic", """
SELECT event_id, ts::DATE AS day, (ts::DATE)::TIMESTAMP AS midnight, ts - INTERVAL 5 MINUTE AS before,
       date_trunc('hour', ts) AS hour_start
FROM events
""")
def time_arithmetic(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.to_date("ts").cast("timestamp_ntz").alias("midnight"),
        (F.col("ts") - F.expr("interval 5 minutes")).alias("before"),
        hour_start("ts").alias("hour_start"),
    )


@query("fn_15_parse_timestamps", """
SELECT event_id, date_trunc('second', ts) AS by_pattern, CASE WHEN event_id % 7 > 0 THEN ts END AS by_iso FROM events
""")
def parsed_timestamps(spark, sf_dir):
    stamp = F.date_format("ts", STAMP)
    iso = F.when(F.col("event_id") % 7 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise("")
    rows = given(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"), iso.alias("iso"))
    return rows.select(
        "event_id",
        casts.strict_timestamp("stamp", STAMP).alias("by_pattern"),
        casts.strict_timestamp("iso").alias("by_iso"),
    )


@query("fn_16_aggregates", """
SELECT l_returnflag, count(*) AS rows, sum(l_linenumber)::BIGINT AS lines, round(avg(l_quantity), 9) AS avg_quantity,
       min(l_extendedprice) AS low, max(l_extendedprice) AS high, count(DISTINCT l_suppkey) AS suppliers,
       any_value(l_returnflag) AS label, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
       round(count(*) FILTER (WHERE l_discount > 0.05) / count(*), 9) AS discounted_rate
FROM lineitem GROUP BY l_returnflag
""")
def aggregates(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").withColumn("discounted", F.col("l_discount") > 0.05)
    totals = rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("l_linenumber").alias("lines"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.any_value("l_returnflag", F.lit(True)).alias("label"),
        intermediate.delayed("discounted").alias("discounted"),
    )
    share = intermediate.rate(F.col("discounted"), F.col("rows")).alias("discounted_rate")
    return rounded(totals.select("*", share), "avg_quantity", "discounted_rate")


@query("fn_17_windows", """
SELECT user_id, event_id, ts, hour_rank FROM (
  SELECT user_id, event_id, ts, (rank() OVER (PARTITION BY user_id, ts::DATE ORDER BY hour(ts)))::INTEGER AS hour_rank,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS nth FROM events)
WHERE nth = 1
""")
def windows(spark, sf_dir):
    by_day = Window.partitionBy("user_id", F.to_date("ts")).orderBy(F.hour("ts").asc_nulls_last())
    ranked = given(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "ts", F.rank().over(by_day).alias("hour_rank")
    )
    newest = picking.keep_first(ranked, ["user_id", "event_type"], by=["ts"], descending=["ts"])
    return newest.select("user_id", "event_id", "ts", "hour_rank")
