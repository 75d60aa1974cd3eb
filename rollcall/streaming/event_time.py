"""Event time and watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import epoch_ms_to_timestamp
from ..operators.ordered import micros

OUT_OF_ORDER = "10 seconds"
NO_LATENESS = "0 seconds"


def with_event_time(df: DataFrame, field: str, ts: str = "ts") -> DataFrame:
    """Event time from a string field with epoch milliseconds."""
    return df.withColumn(ts, epoch_ms_to_timestamp(F.col(field)))


def with_watermark(
    df: DataFrame, field: str, out_of_order: str = OUT_OF_ORDER, lateness: str = NO_LATENESS, ts: str = "ts",
) -> DataFrame:
    """Event time with a watermark.

    A window is kept until the watermark has passed its end, so the time by which
    rows may come late is part of the delay. The price is that rows without a
    match come out that much later.
    """
    delay = micros(out_of_order) + micros(lateness)
    return with_event_time(df, field, ts).withWatermark(ts, f"{delay} microseconds")


def member_time(member: DataFrame, **delays: str) -> DataFrame:
    return with_watermark(member, "register", **delays)


def fact_time(facts: DataFrame, **delays: str) -> DataFrame:
    """For registration types and payments."""
    return with_watermark(facts, "createtime", **delays)
