"""Registered queries: a Spark callable and, where SQL can say the same, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def r6(value: Column) -> Column:
    """Six decimals, and no negative zero: what both engines can agree on for sums of doubles."""
    return F.round(value.cast("double"), 6) + F.lit(0.0)
