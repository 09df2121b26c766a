"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    run: Query
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, or else that of its function."""

    def register(run: Query) -> Query:
        PLANS[name or run.__name__] = Plan(run, sql)
        return run

    return register
