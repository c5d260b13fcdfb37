from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wayside.operators import check_states, quality as q, uniqueness
from wayside.plans.rules import ASSERTIONS, SUITES, TABLE_RULES
from wayside.operators.silver import AGENCY
from wayside.storage import TableStore


def test_declared_counts():
    kinds = [r.kind for rules in TABLE_RULES.values() for r in rules]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 34, "in_range": 22, "unique": 19, "relationships": 10, "accepted_values": 6}
    assert {name: len(s) for name, s in SUITES.items()} == {
        "bronze_vehicle_positions": 7, "bronze_train_positions": 6, "silver_congestion": 5, "silver_weather": 3}
    assert len(ASSERTIONS) + len(SUITES) == 12


def test_rules_of_one_table(spark, rows):
    child = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 50.0), (2, None, None), (None, "z", -1.0), (None, "z", 0.0)], "k int, v string, x double")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "name string")
    rules = [q.not_null("k"), q.unique("k"), q.unique("x"), q.accepted_values("v", ["a", "b"]),
             q.in_range("x", 0, 10), q.relationships("v", "parent", "name")]
    got = q.check_table("child", rules, {"child": child, "parent": parent})
    assert rows(got, "rule", "column_name", "violations", "total", "passed") == [
        ("accepted_values", "v", 2, 4, False),
        ("in_range", "x", 2, 4, False),
        ("not_null", "k", 2, 5, False),
        ("relationships", "v", 2, 4, False),
        ("unique", "k", 1, 3, False),
        ("unique", "x", 0, 4, True),
    ]


def test_null_keys_repeat_for_duplicates_but_not_for_unique(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "k string, n int")
    assert q.no_duplicate_keys("d", df, ["k", "n"]).first().violations == 1
    assert q.check_table("t", [q.unique("n")], {"t": df}).first().violations == 0


@pytest.mark.parametrize("outside, success", [(20, True), (25, False)])
def test_mostly(spark, outside, success):
    rail = spark.range(100).select(
        F.col("id").cast("string").alias("rn"), F.lit("red").alias("rt"),
        F.when(F.col("id") < outside, 0.0).otherwise(41.9).alias("lat"), F.lit(-87.6).alias("lon"))
    suite = "bronze_train_positions"
    results = q.evaluate(suite, rail, SUITES[suite])
    row = results.where("column_name = 'lat'").first()
    assert (row.evaluated, row.unexpected, row.success) == (100, outside, success)
    total = q.suite_result(results).first()
    assert (total.success, total.total, total.passed) == (success, 6, 6 if success else 5)


def test_missing_values_are_not_judged(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (41.5,)], "lat double")
    checks = [q.Expectation(q.BETWEEN, "lat", 41, 43), q.Expectation(q.NOT_NULL, "lat"), q.Expectation(q.ROW_COUNT, low=1)]
    got = q.evaluate("s", df, checks).orderBy("position").collect()
    assert [(r.evaluated, r.unexpected, r.success) for r in got] == [(1, 0, True), (3, 2, False), (3, 0, True)]
    empty = q.evaluate("s", df.limit(0), checks).orderBy("position").collect()
    assert [r.success for r in empty] == [True, True, False]


def test_null_predicate_is_no_violation(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "lat double")
    assert q.zero_violations("c", df, "lat not between 41 and 43").first().violations == 1


def _position(spark, vehicle, lat):
    return spark.createDataFrame([(AGENCY, "bus", vehicle, lat, -87.6)], "agency string, mode string, vehicle_id string, lat double, lon double")


def test_blocking_gate(spark):
    gate = next(a for a in ASSERTIONS if a.blocking)
    clean = _position(spark, "1", 41.9)
    q.enforce(gate.run(gate.name, clean), gate.name)
    dirty = clean.unionByName(_position(spark, "BAD", 0.0))
    with pytest.raises(q.BlockedLoad, match="positions_coords_valid"):
        q.enforce(gate.run(gate.name, dirty), gate.name)
    q.enforce(gate.run(gate.name, dirty.where("vehicle_id <> 'BAD'")), gate.name)


def test_split_rows_quarantines_the_unknown(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "x int")
    good, bad = q.split_rows(df, F.col("x") < 5)
    assert (good.count(), bad.count()) == (1, 2)


def _brute(rows):
    counts = Counter(rows)
    return sum(n > 1 for n in counts.values()), len(rows)


@pytest.mark.parametrize("mark", [F.xxhash64, lambda *c: F.lit(7).cast("long"), lambda *c: F.pmod(F.xxhash64(*c), F.lit(5)), lambda *c: -F.abs(F.hash(*c)).cast("long")])
def test_repeated_keys_in_two_steps(spark, mark):
    """Fingerprints that collide by force, at any place of the bitmap, bring rows to the exact count and change nothing."""
    draw = random.Random(4)
    tables = [
        [(draw.choice("abc"), draw.choice([None, 1, 2]), draw.choice(["x", None])) for _ in range(30)],
        [(f"k{i}", i, None) for i in range(200)],
        [(f"k{i}", i, None) for i in range(200)] + [("k7", 7, None), (None, None, None), (None, None, None)],
        [],
    ]
    for rows in tables:
        df = spark.createDataFrame(rows, "a string, b int, c string").repartition(3)
        assert uniqueness.repeated_keys(df, ["a", "b", "c"], mark) == _brute(rows)
        assert uniqueness.repeated_keys(df, ["a"], mark) == _brute([r[0] for r in rows])


def test_only_keys_that_may_repeat_cross_the_shuffle(spark):
    df = spark.createDataFrame([(f"key{i % 990}",) for i in range(1000)], "k string").repartition(4)
    marks = df.groupBy(F.xxhash64("k").alias("mark")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    passed = uniqueness.suspects(df, ["k"], marks)
    assert sorted(r["k"] for r in passed.collect()) == sorted(f"key{i}" for i in range(10) for _ in range(2))


def test_unique_texts_are_shuffled_as_fingerprints(spark):
    """A table whose keys don't repeat: no exchange has the key among its columns."""
    df = spark.createDataFrame([(f"key{i}", i) for i in range(100)], "k string, n int")
    result = q.check_table("t", [q.unique("k"), q.unique("n")], {"t": df}).collect()
    assert [(r.violations, r.total, r.passed) for r in result] == [(0, 100, True)] * 2
    plan = df.groupBy(F.xxhash64("k").alias("mark")).count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mark" in plan or "hashpartitioning(_groupingexpression" in plan


def test_states_of_days_merge_into_the_whole_result(spark, tmp_path):
    """Days in any order, loaded again, grown and gone; keys that repeat within a day, between days and never."""
    draw = random.Random(9)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    rules = [q.not_null("k"), q.unique("k"), q.unique("n"), q.unique("u"), q.accepted_values("k", ["k1", "k2"]), q.in_range("n", 0, 40), q.relationships("k", "p", "key")]
    parents = {"p": spark.createDataFrame([("k1",), ("k2",), ("k2",), (None,)], "key string")}

    def made(n):
        rows = [(draw.choice([*days, None]), draw.choice(["k1", "k2", "k3", None]), draw.choice([None, *range(60)]), f"u{i}") for i in range(n)]
        return spark.createDataFrame(rows, "day date, k string, n int, u string")

    store = TableStore(spark, str(tmp_path))

    def merged(df):
        return sorted(map(tuple, check_states.results(store, "t", df, rules, "day", parents).collect()))

    def whole(df):
        return sorted(map(tuple, q.check_table("t", rules, {"t": df, **parents}).collect()))

    first = made(80)
    check_states.refresh(store, "t", first, rules, "day")
    assert merged(first) == whole(first)
    again = made(50).where(F.col("day") == days[0])
    now = first.where(F.coalesce(~F.col("day").isin(days[:2]), F.lit(True))).unionByName(again)
    for _ in range(2):
        check_states.refresh(store, "t", now, rules, "day", days[:2])
    assert merged(now) == whole(now)
    clean = now.where("false")
    check_states.refresh(store, "t", clean, rules, "day", days)
    left = now.where("day is null")
    assert merged(left) == whole(left)
