"""Named pieces of comparison SQL and their composition.

Each piece restates a table row by row over the given tables: joins before
aggregates, one window per deduplication, none of the rewrites the Spark side uses.
"""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}


def _part(name: str, sql: str) -> None:
    PARTS[name] = sql.strip()


def compose(body: str) -> str:
    """Prefix a body with the pieces it mentions, directly or through others."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"\bx_\w+", sql):
            if word not in order:
                if word not in PARTS:
                    raise KeyError(word)
                visit(PARTS[word])
                order.append(word)

    visit(body)
    ctes = ",\n".join(f"{name} AS (\n{PARTS[name]}\n)" for name in order)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def whole(name: str, *doubles: str, digits: int = 9) -> str:
    """All of a piece, its doubles rounded like the Spark side's."""
    if not doubles:
        return compose(f"SELECT * FROM {name}")
    cut = ", ".join(f"round({c}, {digits}) AS {c}" for c in doubles)
    return compose(f"SELECT * REPLACE ({cut}) FROM {name}")


def pick(source: str, keys: str, order: str, keep: str = "* EXCLUDE (nth)") -> str:
    """First row per key."""
    return (
        f"SELECT {keep} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS nth "
        f"FROM {source}) WHERE nth = 1"
    )


def md5_of(*columns: str) -> str:
    texts = ", ".join(f"ifnull({c}::VARCHAR, '_null_')" for c in columns)
    return f"md5(array_to_string([{texts}], '||'))"


IN_BOX = "lat >= 41 AND lat <= 43 AND lon >= -89 AND lon <= -87"

# --- landed ------------------------------------------------------------------

_EVENT = """
    41.0::DOUBLE + (event_id % 203)::DOUBLE / 100 AS lat,
    -89.0::DOUBLE + (event_id % 207)::DOUBLE / 100 AS lon,
"""

_part("x_bus", f"""
SELECT user_id::VARCHAR AS vid, date_trunc('hour', ts) AS tmstmp, {_EVENT}
       (event_id % 360)::INTEGER AS hdg, user_id % 50 AS pid, 'NATION_' || (user_id % 30) AS rt,
       event_type AS des, event_id % 5000 AS pdist, event_type = 'error' AS dly,
       event_id::VARCHAR AS tatripid, (event_id % 1000)::VARCHAR AS origtatripno,
       (user_id % 30)::VARCHAR AS tablockid,
       CASE event_id % 3 WHEN 1 THEN 'Z1' WHEN 2 THEN 'Z2' END AS zone, ts AS _ingested_at
FROM events WHERE user_id % 4 <> 0
""")
_part("x_decoded", f"""
SELECT user_id::VARCHAR AS vehicle_id, 'NATION_' || (user_id % 30) AS route_id, {_EVENT}
       (event_id % 360)::INTEGER AS heading, event_type = 'error' AS is_delayed,
       (event_id % 40)::VARCHAR AS stop_id, date_trunc('hour', ts) AS report_ts
FROM events WHERE user_id % 4 = 0
""")
_part("x_routes", """
SELECT n_name AS route_id, n_nationkey::VARCHAR AS route_short_name, 'Line ' || n_name AS route_long_name,
       (n_nationkey % 5)::VARCHAR AS route_type, 'FF0000' AS route_color, 'FFFFFF' AS route_text_color
FROM nation
""")
_part("x_stops", """
SELECT s_suppkey::VARCHAR AS stop_id, 'C' || s_suppkey AS stop_code, s_name AS stop_name,
       CASE WHEN s_suppkey % 10 = 9 THEN '' ELSE (41 + s_nationkey % 3)::VARCHAR END AS stop_lat,
       (s_nationkey % 3 - 89)::VARCHAR AS stop_lon,
       ['0', '1', '2.7', ' 7 ', '', 'abc', '1e3'][s_suppkey % 7 + 1] AS location_type,
       CASE WHEN s_suppkey % 4 = 0 THEN (s_suppkey % 11)::VARCHAR END AS parent_station,
       ['1', '2.5', '-2.5'][s_suppkey % 3 + 1] AS wheelchair_boarding
FROM supplier
""")
_part("x_trips", """
SELECT 'NATION_' || (o_custkey % 27) AS route_id, o_orderpriority AS service_id, o_orderkey::VARCHAR AS trip_id,
       ['Northbound', 'Southbound', 'Eastbound'][o_orderkey % 3 + 1] AS direction,
       (o_orderkey % 2)::VARCHAR AS direction_id, (o_orderkey % 97)::VARCHAR AS block_id,
       o_orderstatus AS shape_id, 'S' || o_orderkey AS schd_trip_id,
       ['0', '1', 'x'][o_orderkey % 3 + 1] AS wheelchair_accessible
FROM orders
""")
_part("x_stop_times", """
SELECT l_orderkey::VARCHAR AS trip_id, l_suppkey::VARCHAR AS stop_id,
       format('{:02d}:{:02d}:00', l_partkey % 28, l_suppkey % 60) AS arrival_time,
       format('{:02d}:{:02d}:00', l_partkey % 28, l_suppkey % 60) AS departure_time,
       l_linenumber::VARCHAR AS stop_sequence, 'To ' || l_returnflag AS stop_headsign, '0' AS pickup_type,
       (l_partkey % 100) || '.5' AS shape_dist_traveled
FROM lineitem
""")
_part("x_congestion", """
SELECT l_suppkey::VARCHAR AS segment_id,
       strftime(DATE '2018-01-01' + (l_partkey % 60)::INTEGER, '%Y-%m-%d')
         || format('T{:02d}:00:00.000', l_partkey % 24) AS time,
       (l_quantity::INTEGER - 3)::VARCHAR AS speed, 'Street ' || l_suppkey AS street,
       ['NB', 'SB', 'EB', 'WB'][l_suppkey % 4 + 1] AS direction, 'From ' || (l_suppkey % 7) AS from_street,
       'To ' || (l_suppkey % 5) AS to_street, (l_suppkey % 9) || '.5' AS length,
       l_linenumber::VARCHAR AS bus_count, (l_orderkey % 30)::VARCHAR AS message_count,
       (l_partkey % 24)::VARCHAR AS hour, (l_partkey % 60 % 7 + 1)::VARCHAR AS day_of_week,
       month(DATE '2018-01-01' + (l_partkey % 60)::INTEGER)::VARCHAR AS month,
       format('41.{:02d}', l_suppkey % 100) AS start_latitude, format('-87.{:02d}', l_suppkey % 100) AS start_longitude,
       format('42.{:02d}', l_suppkey % 100) AS end_latitude, format('-88.{:02d}', l_suppkey % 100) AS end_longitude,
       TIMESTAMP '2018-04-01' + to_seconds(l_orderkey) AS _ingested_at
FROM lineitem
""")
_part("x_weather", """
SELECT DATE '2024-01-01' + (o_orderkey % 40)::INTEGER AS date, o_totalprice / 20000 AS temperature_2m_max,
       o_totalprice / 20000 - 5 AS temperature_2m_min, (o_custkey % 4)::DOUBLE AS precipitation_sum,
       (o_custkey % 2)::DOUBLE AS rain_sum, (o_custkey % 3)::DOUBLE AS snowfall_sum,
       (o_custkey % 60)::DOUBLE AS wind_speed_10m_max, (o_custkey % 90)::DOUBLE AS wind_gusts_10m_max,
       TIMESTAMP '2024-03-01' + to_seconds(o_orderkey) AS _ingested_at
FROM orders
""")

# --- conformed ---------------------------------------------------------------

_part("x_silver_routes", """
SELECT 'CTA' AS agency, * REPLACE (try_cast(route_type AS INTEGER) AS route_type) FROM x_routes
""")
_part("x_silver_stops", """
SELECT 'CTA' AS agency, * REPLACE (
         try_cast(stop_lat AS DOUBLE) AS stop_lat, try_cast(stop_lon AS DOUBLE) AS stop_lon,
         try_cast(location_type AS INTEGER) AS location_type,
         try_cast(wheelchair_boarding AS INTEGER) AS wheelchair_boarding)
FROM x_stops
""")
_part("x_silver_trips", """
SELECT 'CTA' AS agency, * EXCLUDE (direction) REPLACE (
         try_cast(direction_id AS INTEGER) AS direction_id,
         try_cast(wheelchair_accessible AS INTEGER) AS wheelchair_accessible),
       direction AS direction_name
FROM x_trips
""")
_part("x_silver_stop_times", """
SELECT 'CTA' AS agency, * REPLACE (
         try_cast(stop_sequence AS INTEGER) AS stop_sequence,
         try_cast(shape_dist_traveled AS DOUBLE) AS shape_dist_traveled),
       list_sum(list_transform(list_zip(string_split(arrival_time, ':'), [3600, 60, 1]),
                               lambda p: p[1]::BIGINT * p[2]))::BIGINT AS arrival_sec
FROM x_stop_times
""")
_part("x_silver_trains", pick(
    "x_decoded", "vehicle_id, report_ts", "route_id, lat, lon, heading, is_delayed, stop_id"))
_part("x_reports", f"""
SELECT 'CTA' AS agency, 'bus' AS mode, vid AS vehicle_id, rt AS route_id, des AS headsign, lat, lon,
       hdg AS heading, dly AS is_delayed, tmstmp AS report_ts, _ingested_at
FROM x_bus WHERE {IN_BOX}
UNION ALL
SELECT 'CTA', 'train', vehicle_id, route_id, CAST(NULL AS VARCHAR), lat, lon, heading, is_delayed, report_ts, report_ts
FROM x_silver_trains WHERE {IN_BOX}
""")
_part("x_silver_positions", pick(
    "x_reports", "mode, vehicle_id, report_ts", "_ingested_at, route_id, headsign, lat, lon, heading, is_delayed"))
_part("x_silver_congestion", f"""
SELECT try_cast(segment_id AS INTEGER) AS segment_id, time::TIMESTAMP AS report_ts,
       try_cast(speed AS INTEGER) AS speed_mph, street, direction, from_street, to_street,
       try_cast(length AS DOUBLE) AS length_mi,
       COLUMNS(['bus_count', 'message_count', 'hour', 'day_of_week', 'month'])::INTEGER,
       start_latitude::DOUBLE AS start_lat, start_longitude::DOUBLE AS start_lon,
       end_latitude::DOUBLE AS end_lat, end_longitude::DOUBLE AS end_lon
FROM ({pick("(SELECT * FROM x_congestion WHERE try_cast(speed AS INTEGER) >= 0)", "segment_id, time",
            "_ingested_at, speed, bus_count, message_count")})
""")
_part("x_silver_weather", f"""
SELECT date AS weather_date, temperature_2m_max AS temp_max_c, temperature_2m_min AS temp_min_c,
       precipitation_sum AS precip_mm, rain_sum AS rain_mm, snowfall_sum AS snow_cm,
       wind_speed_10m_max AS wind_kmh, wind_gusts_10m_max AS gust_kmh
FROM ({pick("x_weather", "date", "_ingested_at DESC")})
""")

# --- staging -----------------------------------------------------------------

_part("x_stg_routes", """
SELECT *, ifnull(['tram', 'subway', 'rail', 'bus'][route_type + 1], 'other') AS route_type_name FROM x_silver_routes
""")
_part("x_stg_stops", "SELECT * FROM x_silver_stops WHERE (stop_lat + stop_lon) IS NOT NULL")
_part("x_stg_trips", "SELECT * FROM x_silver_trips")
_part("x_stg_stop_times", """
SELECT *, floor(arrival_sec / 3600)::BIGINT % 24 AS scheduled_hour FROM x_silver_stop_times
""")
_part("x_stg_positions", f"""
SELECT {md5_of('mode', 'vehicle_id', 'report_ts')} AS position_sk, *, report_ts::DATE AS report_date,
       hour(report_ts)::INTEGER AS report_hour
FROM x_silver_positions
""")
_part("x_stg_congestion", """
SELECT * RENAME (hour AS report_hour), report_ts::DATE AS report_date FROM x_silver_congestion
""")
_part("x_stg_weather", """
SELECT *, (temp_max_c + temp_min_c) / 2 AS temp_avg_c, precip_mm > 0 AS is_wet_day, snow_cm > 0 AS is_snow_day
FROM x_silver_weather
""")

# --- aggregates --------------------------------------------------------------

_part("x_enriched", """
SELECT p.* EXCLUDE (_ingested_at), ifnull(r.route_long_name, p.route_id) AS route_name
FROM x_stg_positions p LEFT JOIN x_stg_routes r ON p.mode = 'bus' AND r.route_id = p.route_id
""")
_part("x_delay_hours", """
SELECT agency, mode, route_id, route_name, report_date, report_hour, count(*) AS report_count,
       count(*) FILTER (WHERE is_delayed) AS delayed_count, count(DISTINCT vehicle_id) AS active_vehicles,
       avg(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS delayed_rate
FROM x_enriched GROUP BY ALL
""")
_part("x_delay_days", """
SELECT report_date, mode, count(*) AS report_count, count(*) FILTER (WHERE is_delayed) AS delayed_count,
       count(DISTINCT vehicle_id) AS active_vehicles, count(DISTINCT route_id) AS active_routes,
       avg(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS delayed_rate
FROM x_enriched GROUP BY ALL
""")
_part("x_road_hours", """
SELECT segment_id, street, direction, from_street, to_street, report_date, report_hour, day_of_week,
       count(*) AS observation_count, avg(speed_mph) AS avg_speed_mph, min(speed_mph) AS min_speed_mph,
       avg(length_mi) AS length_mi, avg(start_lat) AS start_lat, avg(start_lon) AS start_lon
FROM x_stg_congestion GROUP BY ALL
""")
_part("x_road_days", """
SELECT report_date, count(*) AS observation_count, count(DISTINCT segment_id) AS active_segments,
       avg(speed_mph) AS avg_speed_mph,
       avg(CASE WHEN speed_mph < 30 THEN (30 - speed_mph) / 30 ELSE 0 END) AS congestion_index
FROM x_stg_congestion GROUP BY ALL
""")

# --- star schema -------------------------------------------------------------

_part("x_dim_date", """
SELECT d::DATE AS date_day, strftime(d, '%Y%m%d')::INTEGER AS date_key,
       year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
       strftime(d, '%B') AS month_name, day(d)::INTEGER AS day_of_month, (isodow(d) % 7)::INTEGER AS day_of_week,
       strftime(d, '%A') AS day_name, strftime(d, '%V')::INTEGER AS week_of_year, isodow(d) > 5 AS is_weekend
FROM range(DATE '2018-01-01', DATE '2027-01-01', INTERVAL 1 DAY) t(d)
""")
_part("x_dim_agency", """
SELECT 'CTA' AS agency, 'Chicago Transit Authority' AS agency_name, 'Chicago, IL' AS locale, TRUE AS is_active
""")
_part("x_dim_mode", """
SELECT * FROM (VALUES ('bus', 'Bus', 'CTA bus fleet (BusTime)'),
                      ('train', 'Rail', 'CTA "L" rail lines (Train Tracker)')) t(mode, mode_name, description)
""")
_part("x_dim_route", f"""
SELECT {md5_of('mode', 'route_id')} AS route_sk, 'CTA' AS agency, * FROM (
  SELECT DISTINCT 'bus' AS mode, route_id, route_long_name AS route_name, route_short_name, route_type_name, route_color
  FROM x_stg_routes
  UNION ALL
  SELECT DISTINCT mode, route_id, route_id, CAST(NULL AS VARCHAR), if(mode = 'train', 'subway', 'bus'),
         CAST(NULL AS VARCHAR)
  FROM x_stg_positions
  WHERE NOT (mode = 'bus' AND route_id IN (SELECT route_id FROM x_stg_routes)))
""")
_part("x_dim_stop", f"SELECT {md5_of('agency', 'stop_id')} AS stop_sk, * FROM x_stg_stops")
_part("x_dim_segment", f"""
SELECT segment_id, {md5_of('segment_id')} AS segment_sk, min(street) AS street, min(direction) AS direction,
       min(from_street) AS from_street, min(to_street) AS to_street, avg(length_mi) AS length_mi,
       avg(start_lat) AS start_lat, avg(start_lon) AS start_lon, avg(end_lat) AS end_lat, avg(end_lon) AS end_lon
FROM x_stg_congestion GROUP BY segment_id
""")
_part("x_fact_position", f"""
SELECT * EXCLUDE (headsign), {md5_of('mode', 'route_id')} AS route_sk, strftime(report_ts, '%Y%m%d')::INTEGER AS date_key
FROM x_enriched
""")
_part("x_fact_delay", "SELECT * EXCLUDE (heading, is_delayed) FROM x_fact_position WHERE is_delayed")
_part("x_fact_congestion", f"""
SELECT {md5_of('segment_id', 'report_ts')} AS congestion_sk, {md5_of('segment_id')} AS segment_sk,
       strftime(report_ts, '%Y%m%d')::INTEGER AS date_key, segment_id, report_ts, report_date, report_hour,
       day_of_week, speed_mph, bus_count, message_count, length_mi
FROM x_stg_congestion
""")
_part("x_fact_weather", "SELECT strftime(weather_date, '%Y%m%d')::INTEGER AS date_key, * FROM x_stg_weather")

# --- marts -------------------------------------------------------------------

_OTP = """sum(report_count)::BIGINT AS total_reports, sum(delayed_count)::BIGINT AS delayed_reports"""
_SHARE = "(sum(report_count) - sum(delayed_count))::DOUBLE / sum(report_count) AS on_time_rate"

_part("x_otp_route", f"""
SELECT agency, mode, route_id, route_name, {_OTP}, max(active_vehicles) AS peak_vehicles, {_SHARE}
FROM x_delay_hours GROUP BY ALL
""")
_part("x_otp_mode_hour", f"SELECT mode, report_hour, {_OTP}, {_SHARE} FROM x_delay_hours GROUP BY ALL")
_part("x_otp_route_hour", f"""
SELECT agency, mode, route_id, route_name, report_hour, {_OTP}, {_SHARE} FROM x_delay_hours GROUP BY ALL
""")
_part("x_fleet_activity", """
SELECT agency, mode, route_id, route_name, report_date, max(active_vehicles) AS peak_vehicles,
       sum(report_count)::BIGINT AS reports
FROM x_delay_hours GROUP BY ALL
""")
_part("x_delay_trend", """
SELECT d.*, strftime(d.report_date, '%A') AS day_name, isodow(d.report_date) > 5 AS is_weekend FROM x_delay_days d
""")
_part("x_delay_weather", """
SELECT d.* EXCLUDE (active_routes), w.temp_avg_c, w.precip_mm, w.snow_cm, w.wind_kmh, w.is_wet_day, w.is_snow_day
FROM x_delay_days d LEFT JOIN x_fact_weather w ON w.weather_date = d.report_date
""")
_part("x_delay_congestion", """
SELECT t.report_hour, t.transit_reports, t.delayed_rate, r.road_avg_speed_mph, r.segment_hours
FROM (SELECT report_hour, count(*) AS transit_reports, avg(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS delayed_rate
      FROM x_enriched GROUP BY ALL) t
LEFT JOIN (SELECT report_hour, avg(avg_speed_mph) AS road_avg_speed_mph, count(*) AS segment_hours
           FROM x_road_hours GROUP BY ALL) r ON r.report_hour = t.report_hour
""")
_part("x_road_by_hour", """
SELECT report_hour, count(DISTINCT segment_id) AS segments, sum(observation_count)::BIGINT AS observations,
       avg(avg_speed_mph) AS avg_speed_mph
FROM x_road_hours GROUP BY ALL
""")
_part("x_hotspots", """
SELECT s.*, (rank() OVER (ORDER BY avg_speed_mph))::BIGINT AS congestion_rank
FROM (SELECT h.segment_id, min(street) AS street, min(from_street) AS from_street, min(to_street) AS to_street,
             sum(observation_count)::BIGINT AS observations, avg(h.avg_speed_mph) AS avg_speed_mph,
             min(report_hour) FILTER (WHERE h.avg_speed_mph = low.slowest) AS worst_hour,
             avg(start_lat) AS start_lat, avg(start_lon) AS start_lon
      FROM x_road_hours h
      JOIN (SELECT segment_id, min(avg_speed_mph) AS slowest FROM x_road_hours GROUP BY ALL) low
        ON low.segment_id = h.segment_id
      GROUP BY h.segment_id) s
""")
_part("x_speed_profile", """
SELECT segment_id, street, report_hour, sum(observation_count)::BIGINT AS observations,
       avg(avg_speed_mph) AS avg_speed_mph, min(min_speed_mph) AS min_speed_mph
FROM x_road_hours GROUP BY ALL
""")
_part("x_busiest", """
SELECT s.stop_id, s.stop_name, s.stop_lat, s.stop_lon, count(*) AS scheduled_departures,
       count(DISTINCT t.trip_id) AS distinct_trips
FROM x_stg_stop_times t, x_dim_stop s WHERE s.stop_id = t.stop_id GROUP BY ALL
""")
_part("x_service", """
SELECT t.route_id, r.route_long_name AS route_name, count(DISTINCT t.trip_id) AS scheduled_trips,
       count(DISTINCT service_id) AS service_patterns, count(DISTINCT shape_id) AS shapes,
       count(v.trip_id) AS total_stop_events
FROM x_stg_trips t LEFT JOIN x_stg_stop_times v ON v.trip_id = t.trip_id
LEFT JOIN x_stg_routes r ON r.route_id = t.route_id
GROUP BY ALL
""")
_part("x_route_summary", """
SELECT r.route_sk, r.agency, r.mode, r.route_id, r.route_name, r.route_type_name,
       ifnull(o.total_reports, 0) AS total_reports, ifnull(o.delayed_reports, 0) AS delayed_reports,
       o.peak_vehicles, o.on_time_rate
FROM x_dim_route r LEFT JOIN x_otp_route o ON (o.mode, o.route_id) = (r.mode, r.route_id)
""")
_part("x_freshness", """
SELECT 'vehicle_positions' AS source, max(report_ts) AS latest_ts, count(*) AS row_count FROM x_fact_position
UNION ALL SELECT 'trip_delay', max(report_ts), count(*) FROM x_fact_delay
UNION ALL SELECT 'congestion', max(report_ts), count(*) FROM x_fact_congestion
UNION ALL SELECT 'weather', max(weather_date)::TIMESTAMP, count(*) FROM x_fact_weather
""")
