"""Checks over the built lake and over the landed feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from registry import query
from registry.inputs import Landed, built
from registry.parts import compose
from wayside.operators import check_states, quality, uniqueness
from wayside.plans.rules import ASSERTIONS, SUITES, TABLE_RULES, rules_of
from wayside.storage import TableStore, fresh_folder

# Graph table -> piece of comparison SQL with the same rows.
PIECE = {
    "stg_routes": "x_stg_routes",
    "stg_stops": "x_stg_stops",
    "stg_trips": "x_stg_trips",
    "stg_stop_times": "x_stg_stop_times",
    "stg_vehicle_positions": "x_stg_positions",
    "stg_congestion": "x_stg_congestion",
    "stg_weather": "x_stg_weather",
    "dim_date": "x_dim_date",
    "dim_agency": "x_dim_agency",
    "dim_mode": "x_dim_mode",
    "dim_route": "x_dim_route",
    "dim_stop": "x_dim_stop",
    "dim_segment": "x_dim_segment",
    "fact_vehicle_position": "x_fact_position",
    "fact_trip_delay": "x_fact_delay",
    "fact_congestion": "x_fact_congestion",
    "fact_weather_daily": "x_fact_weather",
    "mart_otp_by_route": "x_otp_route",
    "mart_otp_by_mode_hour": "x_otp_mode_hour",
    "mart_otp_by_route_hour": "x_otp_route_hour",
    "mart_congestion_hotspots": "x_hotspots",
    "mart_congestion_by_hour": "x_road_by_hour",
    "mart_daily_delay_trend": "x_delay_trend",
    "mart_delay_vs_weather": "x_delay_weather",
    "mart_delay_vs_congestion": "x_delay_congestion",
}


def _literals(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _rule_sql(table: str, rule: quality.Rule) -> str:
    """(violations, total) of one rule, each written as a plain subquery."""
    piece, c = PIECE[table], rule.column
    present = f"(SELECT count({c}) FROM {piece})"
    total = f"(SELECT count(*) FROM {piece})" if rule.kind == "not_null" else present
    bad = {
        "not_null": lambda: f"SELECT count(*) FROM {piece} WHERE {c} IS NULL",
        "unique": lambda: f"SELECT count(*) FROM (SELECT {c} FROM {piece} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
        "accepted_values": lambda: f"SELECT count(*) FROM {piece} WHERE NOT ({c} IN ({_literals(rule.values)}))",
        "in_range": lambda: f"SELECT count(*) FROM {piece} WHERE {c} NOT BETWEEN {rule.low} AND {rule.high}",
        "relationships": lambda: (
            f"SELECT count({c}) FROM {piece} WHERE {c} NOT IN "
            f"(SELECT {rule.field} FROM {PIECE[rule.parent]} WHERE {rule.field} IS NOT NULL)"
        ),
    }[rule.kind]()
    return (
        f"SELECT '{table}' AS table_name, '{rule.kind}' AS rule, '{c}' AS column_name, "
        f"({bad}) AS violations, {total} AS total, ({bad}) = 0 AS passed"
    )


def _read_by(declared) -> list[str]:
    """The tables that rules are about, and those their relationships lead to."""
    parents = {rule.parent for rules in declared.values() for rule in rules if rule.kind == "relationships"}
    return sorted(parents | {table for table, rules in declared.items() if rules})


def _rules(name: str, kind: str) -> None:
    declared = rules_of(kind)
    sql = "\nUNION ALL\n".join(_rule_sql(table, rule) for table, rules in declared.items() for rule in rules)

    @query(name, compose(sql))
    def run(spark, sf_dir):
        tables, _, _ = built(spark, sf_dir, *_read_by(declared))
        return quality.check_tables(declared, tables)


_rules("dq_01_not_null", "not_null")
_rules("dq_02_unique", "unique")
_rules("dq_03_relationships", "relationships")
_rules("dq_04_accepted_values", "accepted_values")
_rules("dq_05_in_range", "in_range")

# --- suites --------------------------------------------------------------------

# Raw rail rows for the rail suite: every line name, and a share of trains at 0/0.
_RAIL = "['red', 'blue', 'brn', 'g', 'org', 'p', 'pink', 'Express']"
SUITE_SOURCE = {
    "bronze_vehicle_positions": "SELECT * FROM x_bus",
    "bronze_train_positions": f"""
        SELECT vehicle_id AS rn, {_RAIL}[vehicle_id::BIGINT % 8 + 1] AS rt,
               CASE WHEN heading % 6 = 0 THEN 0 ELSE lat END AS lat,
               CASE WHEN heading % 4 = 0 THEN 0 ELSE lon END AS lon
        FROM x_decoded""",
    "silver_congestion": "SELECT * FROM x_silver_congestion",
    "silver_weather": "SELECT * FROM x_silver_weather",
}


def suite_frame(spark, sf_dir, suite: str) -> DataFrame:
    landed = Landed(spark, sf_dir)
    if suite == "bronze_vehicle_positions":
        return landed["bus_positions"]
    if suite == "bronze_train_positions":
        lines = ["red", "blue", "brn", "g", "org", "p", "pink", "Express"]
        which = (F.col("vehicle_id").cast("bigint") % len(lines) + 1).cast("int")
        return landed["decoded_trains"].select(
            F.col("vehicle_id").alias("rn"),
            F.element_at(F.array(*map(F.lit, lines)), which).alias("rt"),
            F.when(F.col("heading") % 6 == 0, 0.0).otherwise(F.col("lat")).alias("lat"),
            F.when(F.col("heading") % 4 == 0, 0.0).otherwise(F.col("lon")).alias("lon"),
        )
    return built(spark, sf_dir, suite)[0][suite]


def _expectation_sql(suite: str, position: int, e: quality.Expectation) -> str:
    kind = f"SELECT '{suite}' AS suite, {position} AS position, '{e.kind}' AS expectation, "
    kind += f"'{e.column}' AS column_name, " if e.column else "CAST(NULL AS VARCHAR) AS column_name, "
    if e.kind == quality.ROW_COUNT:
        return kind + f"count(*) AS evaluated, (count(*) < {e.low})::BIGINT AS unexpected, count(*) >= {e.low} AS success FROM src"
    if e.kind == quality.NOT_NULL:
        judged, bad = "count(*)", f"count(*) FILTER (WHERE {e.column} IS NULL)"
    else:
        judged = f"count({e.column})"
        wrong = f"{e.column} NOT IN ({_literals(e.values)})" if e.values else f"({e.column} < {e.low} OR {e.column} > {e.high})"
        bad = f"count(*) FILTER (WHERE {wrong})"
    return kind + f"{judged} AS evaluated, {bad} AS unexpected, coalesce(1 - {bad} / {judged} >= {e.mostly}, TRUE) AS success FROM src"


def _suite_sql(suite: str) -> str:
    rows = " UNION ALL ".join(_expectation_sql(suite, i + 1, e) for i, e in enumerate(SUITES[suite]))
    return f"SELECT * FROM (WITH src AS ({SUITE_SOURCE[suite]}) {rows})"


def _results(spark, sf_dir, suites) -> DataFrame:
    frames = [quality.evaluate(s, suite_frame(spark, sf_dir, s), SUITES[s]) for s in suites]
    return reduce(DataFrame.unionByName, frames)


def _register_suites() -> None:
    sql = "\nUNION ALL\n".join(_suite_sql(s) for s in SUITES)
    counts = compose(f"SELECT * FROM ({sql}) WHERE expectation = '{quality.ROW_COUNT}'")
    values = compose(f"SELECT * FROM ({sql}) WHERE expectation <> '{quality.ROW_COUNT}'")
    totals = compose(f"""
SELECT suite, min(success::INTEGER) = 1 AS success, count(*) AS total, sum(success::INTEGER)::BIGINT AS passed
FROM ({sql}) GROUP BY suite""")

    @query("dq_06_row_count_between", counts)
    def row_counts(spark, sf_dir):
        return _results(spark, sf_dir, SUITES).where(F.col("expectation") == quality.ROW_COUNT)

    @query("dq_07_values_with_mostly", values)
    def value_checks(spark, sf_dir):
        return _results(spark, sf_dir, SUITES).where(F.col("expectation") != quality.ROW_COUNT)

    @query("dq_08_suite_result", totals)
    def suite_totals(spark, sf_dir):
        return quality.suite_result(_results(spark, sf_dir, SUITES))


_register_suites()


# Tables stored by day; a day's states are enough to bring their results up to date.
_BY_DAY = {"fact_vehicle_position": "report_date", "fact_trip_delay": "report_date", "fact_congestion": "report_date"}


@query("dq_07_states_by_day", compose("\nUNION ALL\n".join(_rule_sql(t, rule) for t in _BY_DAY for rule in TABLE_RULES.get(t, []))))
def results_from_states(spark, sf_dir):
    """All rules of the tables by day: states of all days but the last, then of the last; half a day is loaded again."""
    tables, _, _ = built(spark, sf_dir, *_BY_DAY, *_read_by({t: TABLE_RULES.get(t, []) for t in _BY_DAY}))
    store, found = TableStore(spark, fresh_folder(spark, "states")), []
    for name, day in _BY_DAY.items():
        rules, table = TABLE_RULES.get(name, []), tables[name]
        if not rules:
            continue
        first, last = table.agg(F.min(day), F.max(day)).first()
        check_states.refresh(store, name, table.where((F.col(day) < last) & ((F.col(day) != first) | F.expr("report_hour % 2 = 0"))), rules, day)
        check_states.refresh(store, name, table, rules, day, [first, last])
        found.append(check_states.results(store, name, table, rules, day, tables))
    return reduce(DataFrame.unionByName, found)


# --- assertions ------------------------------------------------------------------

_KEYS = {
    "positions_no_duplicate_reports": ("x_silver_positions", "mode, vehicle_id, report_ts"),
    "routes_unique": ("x_silver_routes", "route_id"),
    "weather_date_unique": ("x_silver_weather", "weather_date"),
}
_BAD_ROWS = {
    "positions_coords_valid": ("x_silver_positions", "lat < 41 OR lat > 43 OR lon < -89 OR lon > -87"),
    "positions_vehicle_id_not_null": ("x_silver_positions", "vehicle_id IS NULL"),
    "positions_mode_valid": ("x_silver_positions", "mode <> 'bus' AND mode <> 'train'"),
    "stops_coords_valid": ("x_silver_stops", "stop_lat < 41 OR stop_lat > 43 OR stop_lon < -89 OR stop_lon > -87"),
    "congestion_speed_nonneg": ("x_silver_congestion", "speed_mph < 0"),
}


def _asserted(names, spark, sf_dir, tables=None) -> DataFrame:
    tables = tables or built(spark, sf_dir, *sorted({a.table for a in ASSERTIONS if a.name in names}))[0]
    return reduce(
        DataFrame.unionByName, [a.run(a.name, tables[a.table]) for a in ASSERTIONS if a.name in names]
    )


def _count_sql(name: str, inner: str) -> str:
    return f"SELECT '{name}' AS check_name, n AS violations, n = 0 AS passed FROM (SELECT count(*) AS n FROM {inner})"


@query("dq_09_zero_violations", compose(
    "\nUNION ALL\n".join(_count_sql(n, f"{piece} WHERE {bad}") for n, (piece, bad) in _BAD_ROWS.items())))
def zero_violation_checks(spark, sf_dir):
    return _asserted(_BAD_ROWS, spark, sf_dir)


@query("dq_10_no_duplicate_keys", compose("\nUNION ALL\n".join(
    _count_sql(n, f"(SELECT {keys} FROM {piece} GROUP BY ALL HAVING count(*) > 1)") for n, (piece, keys) in _KEYS.items())))
def duplicate_key_checks(spark, sf_dir):
    return _asserted(_KEYS, spark, sf_dir)


@query("dq_10_duplicates_in_raw_reports", compose(
    _count_sql("raw_reports", "(SELECT vid, tmstmp, zone FROM x_bus GROUP BY ALL HAVING count(*) > 1)")))
def raw_duplicates(spark, sf_dir):
    return quality.no_duplicate_keys("raw_reports", Landed(spark, sf_dir)["bus_positions"], ["vid", "tmstmp", "zone"])


_RAW_KEYS = {
    "bus_positions": ("x_bus", ["vid", "tmstmp"]),
    "stop_times": ("x_stop_times", ["trip_id", "stop_id"]),
    "stops": ("x_stops", ["stop_id"]),
    "congestion": ("x_congestion", ["segment_id", "time", "street"]),
}


@query("dq_10_repeated_keys_by_fingerprint", compose("\nUNION ALL\n".join(f"""
SELECT '{name}' AS table_name, (SELECT count(*) FROM (SELECT {", ".join(keys)} FROM {piece} GROUP BY ALL HAVING count(*) > 1)) AS repeated, count(*) AS rows FROM {piece}
""" for name, (piece, keys) in _RAW_KEYS.items())))
def repeated_by_fingerprint(spark, sf_dir):
    """Keys of raw tables counted by 64-bit fingerprints; full keys only where one repeats."""
    landed = Landed(spark, sf_dir)
    rows = [(name, *uniqueness.repeated_keys(landed[name], keys)) for name, (_, keys) in _RAW_KEYS.items()]
    return spark.createDataFrame(rows, "table_name string, repeated bigint, rows bigint")


@query("dq_11_blocking_gate", compose("""
SELECT *, count(*) FILTER (WHERE lane = 'quarantine') OVER () > 0 AS blocked
FROM (SELECT vid, tmstmp, lat, lon, hdg, CASE WHEN lat BETWEEN 41 AND 43 AND lon BETWEEN -89 AND -87 THEN 'accepted' ELSE 'quarantine' END AS lane
      FROM x_bus)
"""))
def gate_split(spark, sf_dir):
    """A failed blocking suite stops the load; its rows go two ways."""
    rows = Landed(spark, sf_dir)["bus_positions"]
    name = "bronze_vehicle_positions"
    suite, blocked = SUITES[name], False
    try:
        quality.enforce(quality.evaluate(name, rows, suite), name, "success")
    except quality.BlockedLoad:
        blocked = True
    good, bad = quality.split_rows(rows, quality.row_condition(rows, suite))
    lanes = good.withColumn("lane", F.lit("accepted")).unionByName(bad.withColumn("lane", F.lit("quarantine")))
    return lanes.select("vid", "tmstmp", "lat", "lon", "hdg", "lane", F.lit(blocked).alias("blocked"))


@query("dq_12_bad_row_regression", compose("""
SELECT stage, check_name, violations, violations = 0 AS passed FROM (
  SELECT 'clean' AS stage, 'positions_coords_valid' AS check_name, count(*) FILTER (WHERE lat < 41) AS violations FROM x_silver_positions
  UNION ALL
  SELECT 'with bad row', 'positions_coords_valid', count(*) FILTER (WHERE lat < 41) + 1 FROM x_silver_positions
  UNION ALL
  SELECT 'restored', 'positions_coords_valid', count(*) FILTER (WHERE lat < 41) FROM x_silver_positions)
"""))
def bad_row_regression(spark, sf_dir):
    """One report at 0/0 must fail the gate, and removing it must clear it."""
    clean = built(spark, sf_dir, "silver_vehicle_positions")[0]["silver_vehicle_positions"]
    newest = clean.agg(F.max("report_ts").alias("report_ts")).select(
        F.lit("CTA").alias("agency"), F.lit("bus").alias("mode"), F.lit("BAD").alias("vehicle_id"),
        F.lit("99").alias("route_id"), F.lit("NOWHERE").alias("headsign"), F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"), F.lit(0).alias("heading"), F.lit(False).alias("is_delayed"), "report_ts",
        F.col("report_ts").alias("_ingested_at"),
    )
    dirty = clean.unionByName(newest)
    stages = {"clean": clean, "with bad row": dirty, "restored": dirty.where("vehicle_id <> 'BAD'")}
    checked = [
        _asserted(["positions_coords_valid"], spark, sf_dir, {"silver_vehicle_positions": rows})
        .withColumn("stage", F.lit(stage))
        for stage, rows in stages.items()
    ]
    return reduce(DataFrame.unionByName, checked)
