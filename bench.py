"""Headline timings: prints one JSON line.

Each query runs over the whole tables at $BENCH_SF_DIR on local[$BENCH_CPUS], once
to warm the JVM and then timed; every timing covers planning and execution, with
all rows and columns computed and none collected.

The landed tables are written first, untimed, in part files of one feed page
(50,000 rows) as the loads leave them. `conform_*` reads those files; `mart_*` reads
the conformed tables of a built lake; `lake_build` writes the full graph from landed
files to marts; `all_table_checks` runs the 91 declared rules on its tables.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

CONFORMS = ["silver_stop_times", "silver_vehicle_positions", "silver_congestion", "silver_weather"]
MARTS = [
    "mart_otp_by_route",
    "mart_otp_by_mode_hour",
    "mart_otp_by_route_hour",
    "mart_fleet_activity_by_route",
    "mart_daily_delay_trend",
    "mart_delay_vs_weather",
    "mart_delay_vs_congestion",
    "mart_congestion_by_hour",
    "mart_congestion_hotspots",
    "mart_segment_speed_profile",
    "mart_busiest_stops",
    "mart_route_service_levels",
    "mart_route_summary",
    "mart_pipeline_freshness",
]


def land(spark, bound):
    """Write the landed tables once and open the files."""
    from wayside.sources.open_data import PAGE_ROWS
    from wayside.storage import fresh_folder

    folder = fresh_folder(spark, "landed")
    opened = {}
    for name, rows in bound.items():
        rows.write.option("maxRecordsPerFile", PAGE_ROWS).parquet(f"{folder}/{name}")
        opened[name] = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return opened


def main() -> None:
    from registry.inputs import Landed
    from wayside.operators import quality
    from wayside.plans import lakehouse
    from wayside.plans.rules import TABLE_RULES
    from wayside.session import local_session
    from wayside.storage import TableStore, fresh_folder

    shared = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(CPUS, "bench", **{"spark.sql.shuffle.partitions": CPUS, "spark.checkpoint.dir": shared})
    landed = land(spark, Landed(spark, SF_DIR))
    timings: dict[str, float] = {}

    def timed(name, run) -> None:
        best = float("inf")
        for attempt in range(REPEATS + 1):
            start = time.perf_counter()
            run()
            if attempt:
                best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)

    def consume(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    for name in CONFORMS:
        timed(f"conform_{name}", lambda: consume(lakehouse.derive(spark, landed, name)))

    built = {}

    def build() -> None:
        store = TableStore(spark, fresh_folder(spark, "bench"))
        built["tables"], _ = lakehouse.build(spark, landed, store)

    timed("lake_build", build)
    silver = {name: frame for name, frame in built["tables"].items() if name.startswith("silver_")}
    for name in MARTS:
        timed(name, lambda: consume(lakehouse.derive(spark, silver, name)))
    timed("all_table_checks", lambda: quality.run_checks(spark, TABLE_RULES, built["tables"]).collect())

    total = round(sum(timings.values()), 3)
    spark.stop()
    report = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": timings, "sf": SF_DIR.rsplit("sf", 1)[-1]}
    print(json.dumps(report), file=sys.__stdout__)


if __name__ == "__main__":
    with contextlib.redirect_stdout(sys.stderr):
        main()
