"""Reading the result of a parameterised query from a database."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        if not math.isfinite(value):
            raise TypeError(f"no SQL literal for {value}")
        return f"({value})" if value < 0 else str(value)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            raise TypeError("no SQL literal for a time with a zone")
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def render_sql(sql: str, params: Sequence[object] = ()) -> str:
    """Put the parameters in place of the ``?`` outside single quotes; Spark's reader binds none itself.

    Comments and quoted names are refused where they hold a ``?`` or a quote could begin in them.
    """
    if params and any(mark in sql for mark in ("--", "/*", '"')):
        raise ValueError("no parameters in a query with comments or quoted names")
    pieces = sql.split("'")
    values = list(params)
    for index in range(0, len(pieces), 2):
        marks = pieces[index].split("?")
        text = marks[0]
        for rest in marks[1:]:
            if not values:
                raise ValueError("fewer parameters than ? marks")
            text += _literal(values.pop(0)) + rest
        pieces[index] = text
    if values:
        raise ValueError("more parameters than ? marks")
    return "'".join(pieces)


def jdbc_query(
    spark: SparkSession,
    url: str,
    sql: str,
    params: Sequence[object] = (),
    *,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Rows of a query. With ``split_on`` the read is shared out over ``splits`` tasks.

    ``bounds`` only places the cuts; rows outside them are read too.
    """
    text = render_sql(sql, params)
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size).options(**options)
    if split_on is None:
        return reader.option("query", text).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({text}) q").option("partitionColumn", split_on)
        .option("lowerBound", low).option("upperBound", high).option("numPartitions", splits).load()
    )
