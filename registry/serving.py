"""Reports over marts, and the constant dimensions seen from the facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import built, model, rounded
from registry.parts import compose, pick
from wayside.operators import serving


@query("dim_01_date", compose("""
SELECT d.*, r.report_count FROM x_dim_date d
LEFT JOIN (SELECT report_date, sum(report_count)::BIGINT AS report_count FROM x_delay_days GROUP BY ALL) r
  ON r.report_date = d.date_day
"""))
def calendar_of_reports(spark, sf_dir):
    days = model(spark, sf_dir, "int_daily_transit_delay").groupBy(F.col("report_date").alias("date_day"))
    reports = days.agg(F.sum("report_count").alias("report_count"))
    return model(spark, sf_dir, "dim_date").join(reports, "date_day", "left")


@query("dim_02_agency", compose("""
SELECT a.*, (SELECT count(*) FROM x_silver_positions p WHERE p.agency = a.agency) AS report_count FROM x_dim_agency a
"""))
def agency_reports(spark, sf_dir):
    reports = model(spark, sf_dir, "silver_vehicle_positions").groupBy("agency").agg(F.count(F.lit(1)).alias("report_count"))
    return model(spark, sf_dir, "dim_agency").join(reports, "agency", "left").fillna(0, ["report_count"])


@query("dim_03_mode", compose("""
SELECT m.*, (SELECT count(*) FROM x_silver_positions p WHERE p.mode = m.mode) AS report_count FROM x_dim_mode m
"""))
def mode_reports(spark, sf_dir):
    reports = model(spark, sf_dir, "silver_vehicle_positions").groupBy("mode").agg(F.count(F.lit(1)).alias("report_count"))
    return model(spark, sf_dir, "dim_mode").join(reports, "mode", "left").fillna(0, ["report_count"])


def _worst(top: int) -> str:
    return compose(f"""
SELECT route_id, route_name, mode, total_reports, round(rate, 9) AS on_time_rate
FROM (SELECT *, 1 - delayed_reports::DOUBLE / total_reports AS rate FROM x_otp_route)
WHERE total_reports >= 20 ORDER BY rate, mode, route_id LIMIT {top}
""")


def worst_routes(spark, sf_dir, top=serving.WORST_ROUTES):
    return rounded(serving.worst_otp(model(spark, sf_dir, "mart_otp_by_route"), top), "on_time_rate")


query("srv_01_worst_otp", _worst(20))(worst_routes)
query("srv_01_worst_otp_top15", _worst(15))(lambda spark, sf_dir: worst_routes(spark, sf_dir, 15))
query("srv_01_worst_otp_top12", _worst(12))(lambda spark, sf_dir: worst_routes(spark, sf_dir, 12))


@query("srv_02_otp_by_hour", compose(
    "SELECT mode, report_hour, round(on_time_rate, 9) AS on_time_rate FROM x_otp_mode_hour"))
def otp_series(spark, sf_dir):
    return rounded(serving.otp_by_hour(model(spark, sf_dir, "mart_otp_by_mode_hour")), "on_time_rate")


def _hotspots(top: int) -> str:
    return compose(f"""
SELECT * REPLACE (round(avg_speed_mph, 9) AS avg_speed_mph, round(start_lat, 9) AS start_lat,
                  round(start_lon, 9) AS start_lon)
FROM (SELECT * FROM x_hotspots ORDER BY congestion_rank, segment_id LIMIT {top})
""")


def slowest_segments(spark, sf_dir, top=serving.HOTSPOTS):
    ranked = model(spark, sf_dir, "mart_congestion_hotspots")
    return rounded(serving.hotspots(ranked, top), "avg_speed_mph", "start_lat", "start_lon")


query("srv_03_hotspots", _hotspots(30))(slowest_segments)
query("srv_03_hotspots_top12", _hotspots(12))(lambda spark, sf_dir: slowest_segments(spark, sf_dir, 12))
query("srv_03_hotspots_top200", _hotspots(200))(lambda spark, sf_dir: slowest_segments(spark, sf_dir, 200))


@query("srv_04_speed_by_hour", compose(
    "SELECT report_hour, round(avg_speed_mph, 9) AS avg_speed_mph FROM x_road_by_hour"))
def speed_series(spark, sf_dir):
    return rounded(serving.speed_by_hour(model(spark, sf_dir, "mart_congestion_by_hour")), "avg_speed_mph")


@query("srv_05_delay_weather_points", compose("""
SELECT report_date, mode, round(delayed_rate, 9) AS delayed_rate, precip_mm, snow_cm, temp_avg_c FROM x_delay_weather
WHERE delayed_rate + precip_mm + temp_avg_c IS NOT NULL
"""))
def weather_points(spark, sf_dir):
    return rounded(serving.delay_weather_points(model(spark, sf_dir, "mart_delay_vs_weather")), "delayed_rate")


@query("srv_06_delay_congestion_points", compose("""
SELECT report_hour, round(delayed_rate, 9) AS delayed_rate, round(road_avg_speed_mph, 9) AS road_avg_speed_mph
FROM x_delay_congestion
"""))
def congestion_points(spark, sf_dir):
    points = serving.delay_congestion_points(model(spark, sf_dir, "mart_delay_vs_congestion"))
    return rounded(points, "delayed_rate", "road_avg_speed_mph")


def _recent(minutes: int) -> str:
    return compose(f"""
SELECT mode, route_id, lat, lon, is_delayed FROM x_fact_position
WHERE report_ts + INTERVAL {minutes} MINUTE >= (SELECT max(report_ts) FROM x_fact_position)
""")


def live_fleet(spark, sf_dir, minutes=serving.LIVE_MINUTES):
    tables, _, _ = built(spark, sf_dir, "fact_vehicle_position")
    return serving.recent_fleet(tables["fact_vehicle_position"], minutes)


query("srv_07_recent_fleet", _recent(5))(live_fleet)
query("srv_07_recent_fleet_30_minutes", _recent(30))(lambda spark, sf_dir: live_fleet(spark, sf_dir, 30))

_FLEET = "agency, mode, route_id, route_name, lat, lon, heading, is_delayed, report_ts"


@query("srv_08_fleet_latest", compose(pick("x_fact_position", "mode, vehicle_id", "report_ts DESC", _FLEET)))
def newest_positions(spark, sf_dir):
    tables, _, _ = built(spark, sf_dir, "fact_vehicle_position")
    return serving.fleet_latest(tables["fact_vehicle_position"])


@query("srv_09_headline", compose("""
SELECT (SELECT count(*) FROM x_fact_position) AS vehicle_position_rows,
       (SELECT count(*) FROM x_fact_congestion) AS congestion_rows,
       (SELECT count(*) FROM x_fact_weather) AS weather_days,
       (SELECT max(report_ts) FROM x_fact_position) AS latest_position
"""))
def headline_figures(spark, sf_dir):
    return serving.headline(model(spark, sf_dir, "mart_pipeline_freshness"))


@query("srv_10_map_points", compose("""
SELECT stop_id, stop_name, stop_lat, stop_lon FROM x_silver_stops WHERE isfinite(stop_lat) AND isfinite(stop_lon)
"""))
def drawable_stops(spark, sf_dir):
    stops = serving.map_points(model(spark, sf_dir, "silver_stops"), "stop_lat", "stop_lon")
    return stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
