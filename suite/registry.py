"""All checks by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .views import SQL

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` follows the shared views and may begin with further ones."""

    def register(run: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        text = None
        if sql is not None:
            body = sql.strip()
            text = SQL.rstrip() + (",\n" + body[len("WITH "):] if body.startswith("WITH ") else "\n" + body)
        CHECKS[name] = Check(run, text)
        return run

    return register


def load() -> dict[str, Check]:
    from . import functions, joins, sources_sinks, streams, transforms  # noqa: F401

    return CHECKS
