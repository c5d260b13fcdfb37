"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is only run, not compared."""

    def keep(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return keep


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from registry import daily, functions, models, quality, serving, sinks, sources, streaming  # noqa: F401

    return QUERIES, ORACLES
