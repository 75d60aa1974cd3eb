"""Counts in tumbling, sliding and session windows of event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def tumbling_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str = "10 minutes") -> DataFrame:
    return df.groupBy(F.window(F.col(ts), size).alias("win"), *keys).agg(F.count("*").alias("n"))


def sliding_counts(
    df: DataFrame, keys: Sequence[str], ts: str, size: str = "10 seconds", step: str = "5 seconds",
) -> DataFrame:
    return df.groupBy(F.window(F.col(ts), size, step).alias("win"), *keys).agg(F.count("*").alias("n"))


def session_counts(df: DataFrame, keys: Sequence[str], ts: str, gap: str = "5 seconds") -> DataFrame:
    """Sessions of a stream. ``ordered.sessions`` gives the same for a batch without gathering a key."""
    return df.groupBy(F.session_window(F.col(ts), gap).alias("win"), *keys).agg(F.count("*").alias("n"))


def flat_window(df: DataFrame, win: str = "win") -> DataFrame:
    """The window as two epoch-microsecond numbers."""
    return df.select(
        F.unix_micros(F.col(f"{win}.start")).alias("start_us"),
        F.unix_micros(F.col(f"{win}.end")).alias("end_us"),
        *[c for c in df.columns if c != win],
    )
