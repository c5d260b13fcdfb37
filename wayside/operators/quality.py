"""Data-quality checks as aggregates, and gates that act on their results.

A check is a frame with one row per rule, so any number of rules costs the
passes their kinds need: all row-level rules of a table share one aggregate,
each key rule adds one shuffle of that key alone, or of its fingerprint if that is smaller.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from wayside.operators.uniqueness import repeated_keys, wide

RESULT = (
    "table_name string, rule string, column_name string, violations bigint, total bigint, passed boolean"
)


class BlockedLoad(RuntimeError):
    """A blocking check failed; what depends on the table must not run."""


# --- rules on tables ---------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: str | None = None
    field: str | None = None


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def unique(column: str) -> Rule:
    return Rule("unique", column)


def accepted_values(column: str, values: Iterable) -> Rule:
    return Rule("accepted_values", column, values=tuple(values))


def in_range(column: str, low: float, high: float) -> Rule:
    return Rule("in_range", column, low=low, high=high)


def relationships(column: str, parent: str, field: str) -> Rule:
    return Rule("relationships", column, parent=parent, field=field)


def _violation(rule: Rule) -> Column:
    value = F.col(rule.column)
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "accepted_values":
        return ~value.isin(*rule.values)
    return (value < rule.low) | (value > rule.high)


def _result_row(table: str, rule: Rule, violations: Column, total: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.column).alias("column_name"),
        violations.alias("violations"),
        total.alias("total"),
        (violations == 0).alias("passed"),
    )


def _row_rules(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules that look at one row at a time, folded into a single aggregate."""
    counts = [F.count(F.lit(1)).alias("n")]
    for i, rule in enumerate(rules):
        counts.append(F.count_if(_violation(rule)).alias(f"bad_{i}"))
        counts.append(F.count(rule.column).alias(f"present_{i}"))
    rows = [
        _result_row(table, rule, F.col(f"bad_{i}"), F.col("n" if rule.kind == "not_null" else f"present_{i}"))
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _key_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def _unique_rule(table: str, df: DataFrame, rule: Rule) -> DataFrame:
    """Non-null values that occur more than once; texts are compared by fingerprint first, now."""
    if wide(df, [rule.column]):
        bad, n = repeated_keys(df.where(F.col(rule.column).isNotNull()), [rule.column])
        return df.sparkSession.createDataFrame([(table, rule.kind, rule.column, bad, n, bad == 0)], RESULT)
    totals = _key_counts(df, rule.column).agg(
        F.count_if(F.col("n") > 1).alias("bad"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n")
    )
    return totals.select(F.inline(F.array(_result_row(table, rule, F.col("bad"), F.col("n")))))


def _relationship_rule(table: str, df: DataFrame, rule: Rule, parent: DataFrame) -> DataFrame:
    """Rows whose non-null value has no parent row.

    Both sides shrink to their distinct keys first: a key held by a third of the
    rows is one row in the join.
    """
    known = parent.select(F.col(rule.field).alias("key")).distinct().withColumn("known", F.lit(True))
    keys = _key_counts(df, rule.column).join(known, "key", "left")
    zero = F.lit(0).cast("bigint")
    totals = keys.agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), zero).alias("bad"),
        F.coalesce(F.sum("n"), zero).alias("n"),
    )
    return totals.select(F.inline(F.array(_result_row(table, rule, F.col("bad"), F.col("n")))))


def check_table(table: str, rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Results of all rules declared for one table."""
    df = tables[table]
    parts = []
    by_row = [r for r in rules if r.kind not in ("unique", "relationships")]
    if by_row:
        parts.append(_row_rules(table, df, by_row))
    parts += [_unique_rule(table, df, r) for r in rules if r.kind == "unique"]
    parts += [_relationship_rule(table, df, r, tables[r.parent]) for r in rules if r.kind == "relationships"]
    return reduce(DataFrame.unionByName, parts)


def check_tables(rules: Mapping[str, Sequence[Rule]], tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check_table(name, rs, tables) for name, rs in rules.items() if rs])


def run_checks(
    spark: SparkSession, rules: Mapping[str, Sequence[Rule]], tables: Mapping[str, DataFrame], jobs: int = 8
) -> DataFrame:
    """The same results, run now: one small plan per table, `jobs` tables at a time.

    One union over all tables makes adaptive execution re-plan all of it after
    every stage; per table it stays cheap. The driver sees one row per rule.
    """
    def check(name: str) -> list[Row]:
        return check_table(name, rules[name], tables).collect()

    with ThreadPoolExecutor(jobs) as pool:
        rows = [row for found in pool.map(check, [name for name in rules if rules[name]]) for row in found]
    return spark.createDataFrame(rows, RESULT)


# --- expectation suites ------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    mostly: float = 1.0


# Public names of the expectation types.
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"


def _limits(value: Column, low: float | None, high: float | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return inside


def _present(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def evaluate(suite: str, df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, from a single aggregate over the table.

    `evaluated` is the number of values judged: all rows for null checks, the
    present ones otherwise (a NaN is not present). An expectation holds when the
    conforming share reaches `mostly`; with nothing to judge it holds.
    """
    counts = [F.count(F.lit(1)).alias("n")]
    for i, e in enumerate(expectations):
        if e.kind == ROW_COUNT:
            continue
        present = _present(df, e.column)
        if e.kind == NOT_NULL:
            judged, good = F.lit(True), present
        else:
            value = F.col(e.column)
            judged = present
            good = present & (value.isin(*e.values) if e.kind == IN_SET else _limits(value, e.low, e.high))
        counts.append(F.count_if(judged).alias(f"judged_{i}"))
        counts.append(F.count_if(good).alias(f"good_{i}"))
    return df.agg(*counts).select(
        F.inline(F.array(*(_expectation_row(suite, i, e) for i, e in enumerate(expectations))))
    )


def _expectation_row(suite: str, i: int, e: Expectation) -> Column:
    if e.kind == ROW_COUNT:
        judged = F.col("n")
        success = _limits(F.col("n"), e.low, e.high)
        unexpected = F.when(success, 0).otherwise(1).cast("bigint")
    else:
        judged, good = F.col(f"judged_{i}"), F.col(f"good_{i}")
        unexpected = judged - good
        success = (judged == 0) | (good / F.nullif(judged, F.lit(0).cast("bigint")) >= e.mostly)
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(i + 1).alias("position"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        judged.alias("evaluated"),
        unexpected.alias("unexpected"),
        success.alias("success"),
    )


def suite_result(results: DataFrame) -> DataFrame:
    """Per suite: overall success, expectations in all, expectations passed."""
    return results.groupBy("suite").agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
    )


# --- assertions on conformed tables -------------------------------------------


def zero_violations(check: str, df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which the predicate is true; unknown ones do not count."""
    return df.agg(F.count_if(F.expr(predicate)).alias("violations")).select(
        F.lit(check).alias("check_name"), "violations", (F.col("violations") == 0).alias("passed")
    )


def no_duplicate_keys(check: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; here NULLs are a key like any other. Wide keys are compared by fingerprint first, now."""
    if wide(df, keys):
        bad, _ = repeated_keys(df, keys)
        return df.sparkSession.createDataFrame([(check, bad, bad == 0)], "check_name string, violations bigint, passed boolean")
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return repeated.agg(F.count_if(F.col("_copies") > 1).alias("violations")).select(
        F.lit(check).alias("check_name"), "violations", (F.col("violations") == 0).alias("passed")
    )


# --- gates ---------------------------------------------------------------------


def enforce(results: DataFrame, label: str, flag: str = "passed") -> None:
    """Stop the load if a blocking check failed. Reads one row per check."""
    failed = results.where(~F.coalesce(F.col(flag), F.lit(False))).collect()
    if failed:
        raise BlockedLoad(f"{label}: " + "; ".join(str(row.asDict()) for row in failed))


def row_condition(df: DataFrame, expectations: Sequence[Expectation]) -> Column:
    """True for rows that no column expectation objects to."""
    valid = F.lit(True)
    for e in expectations:
        if e.kind == ROW_COUNT:
            continue
        present, value = _present(df, e.column), F.col(e.column)
        if e.kind == NOT_NULL:
            valid = valid & present
        else:
            valid = valid & (~present | (value.isin(*e.values) if e.kind == IN_SET else _limits(value, e.low, e.high)))
    return valid


def split_rows(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy a condition, and the rest (unknown included) for quarantine."""
    sure = F.coalesce(valid, F.lit(False))
    return df.where(sure), df.where(~sure)
