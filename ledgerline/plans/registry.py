"""Every query by name, and the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
#: Modules of this package that register queries.
MODULES: tuple[str, ...] = ("scalar", "analytics", "loading", "sheets", "reports", "reading", "governance")


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name, with the SQL that gives the same rows."""

    def add(run: Query) -> Query:
        if run.__name__ in REGISTRY:
            raise ValueError(f"{run.__name__} is registered twice")
        REGISTRY[run.__name__] = Registered(run, sql)
        return run

    return add


def load() -> dict[str, Registered]:
    for name in MODULES:
        importlib.import_module(f"ledgerline.plans.{name}")
    return REGISTRY


def queries() -> dict[str, Query]:
    return {name: r.run for name, r in load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: r.sql for name, r in load().items() if r.sql}
