"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import datetime as dt
import math

import duckdb
import pytest

import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, ORACLES = registry.load()

SQL_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return repr(value)


def _sorted(rows):
    return sorted(tuple(map(_plain, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    assert name in ORACLES, "every query here can be stated in SQL"
    columns = sorted(frame.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    expected = duck.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    assert {c: SQL_TYPE[t] for c, t in frame.dtypes} == types
    assert _sorted(frame.select(*columns).collect()) == _sorted(expected)


def test_open_data_pages_are_compressed_and_bounded(spark, tmp_path):
    """Pages are what the open-data queries write most; a compressed file is one task, so it holds one page at most."""
    from registry import raw_files

    lines = spark.range(900).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id % 7 AS l_suppkey", "cast(id % 4 AS int) AS l_linenumber", "10.0D AS l_quantity", "1.0D AS l_extendedprice",
        "0.0D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'1998-01-01 00:00:00' AS l_shipdate",
    )
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    folder = raw_files.open_data_pages(spark, str(tmp_path))
    files = [p for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    assert sum(p.stat().st_size for p in files) < 900 * 100
    assert spark.read.json(folder).count() == 900


def test_only_the_tables_asked_for_are_written(spark, tmp_path):
    """A check of one table builds what that needs; a later one adds what is missing and writes nothing again."""
    from registry import inputs

    events = spark.range(40).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 08:00:00' AS ts", "id % 8 AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'NATION_1' AS n_name, 0 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    _, rows, store = inputs.built(spark, str(tmp_path), "silver_vehicle_positions")
    assert set(rows) == {"silver_train_positions", "silver_vehicle_positions"}
    before = {p for p in Path(store.root.removeprefix("file:")).rglob("*.parquet")}
    tables, rows, _ = inputs.built(spark, str(tmp_path), "fact_vehicle_position")
    assert set(rows) == {"silver_train_positions", "silver_vehicle_positions", "silver_routes", "fact_vehicle_position"}
    assert before <= {p for p in Path(store.root.removeprefix("file:")).rglob("*.parquet")}
    assert tables["fact_vehicle_position"].count() == rows["fact_vehicle_position"] > 0
