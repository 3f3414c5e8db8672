"""Where named queries and their DuckDB SQL are kept, and what their definitions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.sources.tables import HOUR_US

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_EVENTS = f"(select event_id, event_type as role, user_id, epoch_us(ts) as t, epoch_us(ts) // {HOUR_US} as hour, value, props from events)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; EVENTS in its SQL stands for the event view."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("EVENTS", _EVENTS)
        return f

    return add


def scaled(column: str | Column, by: int = 1000) -> Column:
    """Integers in place of doubles: exact to compare."""
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value * F.lit(float(by)) + 0.5).cast("long")


def sql_scaled(value: str, by: int = 1000) -> str:
    """The same in SQL."""
    return f"cast(floor((({value}) * {by}::double + 0.5::double)) as bigint)"
