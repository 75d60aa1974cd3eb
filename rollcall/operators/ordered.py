"""Operators that need the rows of a key in time order: running counts, previous values, sessions.

A window over the whole key would put a frequent key into one task. Each of
these works on slices of time instead: inside a slice row by row, across slices
on one or two summary rows per key and slice. ``running_count_in_ranges`` cuts by
counted rows, for keys that hold too many rows of one time, or of none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import fresh_dir

# The key as one struct: not NULL even where its fields are, so that it can be
# joined on by plain equality and the join keeps the partitioning of the window.
_KEY = "_key"
_SLICE = "_slice"
_BEFORE_ALL = -(2**63)
_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(interval: str) -> int:
    """``"10 minutes"`` in microseconds."""
    number, unit = interval.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def _sliced(df: DataFrame, keys: Sequence[str], ts: str, size: str) -> DataFrame:
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    start = F.col("_us") - F.pmod(F.col("_us"), F.lit(micros(size)))
    return (
        df.withColumn("_us", us).withColumn(_KEY, F.struct(*keys))
        .withColumn(_SLICE, F.coalesce(start, F.lit(_BEFORE_ALL)))
    )


def running_count(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], name: str = "n", slice_size: str = "10 minutes",
) -> DataFrame:
    """How many rows of the same key came up to and including this one; rows without a time come first."""
    sliced = _sliced(df, keys, ts, slice_size)
    earlier = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(_KEY, _SLICE).agg(F.count("*").alias("_rows"))
        .select(_KEY, _SLICE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(_KEY, _SLICE).orderBy("_us", *tie)
    numbered = sliced.withColumn("_number", F.row_number().over(inside))
    return numbered.join(offsets, [_KEY, _SLICE], "left").select(
        *df.columns, (F.col("_number") + F.col("_before")).alias(name)
    )


def running_count_in_ranges(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], name: str = "n", rows_per_part: int = 1_000_000,
    path: str | None = None,
) -> DataFrame:
    """As ``running_count``, in parts of about ``rows_per_part`` rows wherever a key, a time or rows without a time are frequent.

    The rows are put in order of key, time and tie in ranges cut by their number, and written in that order with their place.
    A key's rows stand one after the other, so a row's number is its distance from the first one in its range, and the
    key's rows in the ranges before, of which there is one sum for each key and range. Ranges are cut by a sample: they are written,
    below the shared folder or at ``path``, so that each later read finds the same ones. Rows that ``tie`` does not tell apart stay in one range.
    """
    parts = max(1, -(-df.count() // rows_per_part))
    order = ["_us", *tie]
    placed = (
        df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
        .repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order).drop("_us")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    path = path or fresh_dir(df.sparkSession, "ranges")
    placed.write.parquet(path)
    stored = (
        df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_at", LongType())])).parquet(path)
        # The upper bits of the place are the number of the range.
        .withColumn(_KEY, F.struct(*keys)).withColumn(_SLICE, F.shiftright("_at", 33))
    )
    earlier = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(_KEY, _SLICE).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
        .select(_KEY, _SLICE, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return stored.join(offsets, [_KEY, _SLICE]).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name)
    )


def previous_time(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], ttl: str = "1 hour",
    name: str = "previous_us", slice_size: str = "10 minutes",
) -> DataFrame:
    """Time of the key's previous row in microseconds, NULL when it is more than ``ttl`` ago and for rows without a time."""
    timed, untimed = df.where(F.col(ts).isNotNull()), df.where(F.col(ts).isNull())
    sliced = _sliced(timed, keys, ts, slice_size)
    slices = Window.partitionBy(_KEY).orderBy(_SLICE)
    earlier = (
        sliced.groupBy(_KEY, _SLICE).agg(F.max("_us").alias("_last"))
        .select(_KEY, _SLICE, F.lag("_last").over(slices).alias("_before"))
    )
    inside = Window.partitionBy(_KEY, _SLICE).orderBy("_us", *tie)
    lagged = sliced.withColumn("_inside", F.lag("_us").over(inside))
    previous = F.coalesce(F.col("_inside"), F.col("_before"))
    found = lagged.join(earlier, [_KEY, _SLICE], "left").select(
        *df.columns,
        F.when(F.col("_us") - previous <= micros(ttl), previous).alias(name),
    )
    return found.unionByName(untimed, allowMissingColumns=True)


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str = "5 seconds", slice_size: str = "10 minutes",
) -> DataFrame:
    """keys, start_us, end_us, n: runs of rows no more than ``gap`` apart; the end is the last row plus ``gap``.

    Rows exactly ``gap`` apart are in one session, as with Spark's ``session_window``.

    Sessions inside a slice are final. Only the first and last of a slice can
    go on in a neighbour, and only those are looked at across slices.
    """
    width = micros(gap)
    sliced = _sliced(df.where(F.col(ts).isNotNull()).select(*keys, ts), keys, ts, slice_size)
    inside = Window.partitionBy(_KEY, _SLICE).orderBy("_us")
    opens = F.when(F.col("_us") - F.lag("_us").over(inside) <= width, 0).otherwise(1)
    runs = (
        sliced.withColumn("_opens", opens)
        .withColumn("_number", F.sum("_opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_runs", F.sum("_opens").over(Window.partitionBy(_KEY, _SLICE)))
        .groupBy(_KEY, _SLICE, "_number", "_runs")
        .agg(F.min("_us").alias("_from"), F.max("_us").alias("_to"), F.count("*").alias("n"))
    )
    at_edge = (F.col("_number") == 1) | (F.col("_number") == F.col("_runs"))
    across = Window.partitionBy(_KEY).orderBy("_from")
    goes_on = F.when(F.col("_from") - F.lag("_to").over(across) <= width, 0).otherwise(1)
    edges = (
        runs.where(at_edge).withColumn("_opens", goes_on)
        .withColumn("_session", F.sum("_opens").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(_KEY, "_session")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("n").alias("n"))
    )
    shape: list[Column] = [
        *[F.col(_KEY)[k].alias(k) for k in keys],
        F.col("_from").alias("start_us"), (F.col("_to") + width).alias("end_us"), F.col("n"),
    ]
    return runs.where(~at_edge).select(*shape).unionByName(edges.select(*shape))
