"""Collects the registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Registers ``fn(spark, sf_dir)`` under a name, with the SQL of the same result."""

    def register(fn: Run) -> Run:
        if name in RUNS:
            raise ValueError(f"query {name} is registered twice")
        RUNS[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
