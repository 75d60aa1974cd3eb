"""Printing a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def show_on_console(df: DataFrame, rows: int, label: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Prints the first ``rows`` of each batch: a look at a stream, no place to keep one."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", "false").option("numRows", rows)
    return writer.queryName(label) if label else writer
