"""Check results merged from states of days: after a new day only that day is read.

For every day a table's state holds, for each row-level rule, violations and values; for each
unique column, how often each 64-bit fingerprint occurs; for each relationship, how often
each key occurs. Sums of these give the result of the whole table. Only where a
fingerprint occurs twice are keys looked at again, of the days that hold it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wayside.operators.quality import RESULT, Rule, _violation
from wayside.operators.uniqueness import suspects
from wayside.storage import TableStore

_BY_ROW = ("not_null", "accepted_values", "in_range")


def refresh(store: TableStore, table: str, df: DataFrame, rules: Sequence[Rule], day: str, days: Sequence[dt.date] | None = None) -> None:
    """Replace the states of some days, or of all, by what the table says now; a rerun changes nothing.

    With the table stored by its `day` column, only those days are read. A day without rows
    any more loses its states.
    """
    if days is not None:
        df = df.where(F.col(day).isin(list(days)))
    for name, states in _states(table, df, rules, day).items():
        store.reload_days(name, states, [day])
    if days is not None:
        left = {r[0] for r in df.select(day).distinct().collect()}
        for gone in set(days) - left:
            for name in _states(table, df, rules, day):
                store.drop(f"{name}/{day}={gone}")


def _name(table: str, kind: str, column: str = "") -> str:
    return f"check_states/{table}/{kind}" + (f"-{column}" if column else "")


def _states(table: str, df: DataFrame, rules: Sequence[Rule], day: str) -> dict[str, DataFrame]:
    by_row = [r for r in rules if r.kind in _BY_ROW]
    counts = [F.count(F.lit(1)).alias("n")]
    for i, rule in enumerate(by_row):
        counts += [F.count_if(_violation(rule)).alias(f"bad_{i}"), F.count(rule.column).alias(f"present_{i}")]
    found = {_name(table, "rows"): df.groupBy(day).agg(*counts)}
    for rule in rules:
        present = df.where(F.col(rule.column).isNotNull())
        if rule.kind == "unique":
            marks = present.groupBy(day, F.xxhash64(rule.column).alias("mark"))
            found[_name(table, "unique", rule.column)] = marks.agg(F.count(F.lit(1)).alias("n"))
        elif rule.kind == "relationships":
            keys = present.groupBy(F.col(day), F.col(rule.column).alias("_key"))
            found[_name(table, "keys", rule.column)] = keys.agg(F.count(F.lit(1)).alias("n"))
    return found


def results(store: TableStore, table: str, df: DataFrame, rules: Sequence[Rule], day: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """What `quality.check_table` gives for the whole table, from the states of all days.

    `df` is the table itself, of which keys are read only where a fingerprint occurs more than once.
    """
    by_row = [r for r in rules if r.kind in _BY_ROW]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for i in range(len(by_row)) for c in (f"bad_{i}", f"present_{i}")]
    rows = store.read(_name(table, "rows")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *sums).first()
    out = []
    for rule in rules:
        if rule.kind in _BY_ROW:
            i = by_row.index(rule)
            bad, total = rows[f"bad_{i}"], rows["n" if rule.kind == "not_null" else f"present_{i}"]
        elif rule.kind == "unique":
            bad, total = _repeated(store.read(_name(table, "unique", rule.column)), df, rule.column, day)
        else:
            bad, total = _orphans(store.read(_name(table, "keys", rule.column)), parents[rule.parent].select(F.col(rule.field).alias("_key")))
        out.append((table, rule.kind, rule.column, bad, total, bad == 0))
    return df.sparkSession.createDataFrame(out, RESULT)


def _repeated(states: DataFrame, df: DataFrame, column: str, day: str) -> tuple[int, int]:
    marks = states.groupBy("mark").agg(F.sum("n").alias("n"))
    seen = marks.agg(F.count_if(F.col("n") > 1).alias("shared"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if not seen["shared"]:
        return 0, seen["rows"]
    repeated = marks.where("n > 1").select("mark")
    days = [r[0] for r in states.join(repeated, "mark", "left_semi").select(day).distinct().collect()]
    held = F.col(day).isin([d for d in days if d is not None])
    rows = df.where(held | F.col(day).isNull() if None in days else held).where(F.col(column).isNotNull())
    exact = suspects(rows, [column], repeated).groupBy(column).agg(F.count(F.lit(1)).alias("_copies"))
    return exact.where("_copies > 1").count(), seen["rows"]


def _orphans(states: DataFrame, known: DataFrame) -> tuple[int, int]:
    keys = states.groupBy("_key").agg(F.sum("n").alias("n"))
    marked = keys.join(known.distinct().withColumn("_known", F.lit(True)), "_key", "left")
    row = marked.agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    ).first()
    return row["bad"], row["n"]
