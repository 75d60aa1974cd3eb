"""Times as they occur in the records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# timestamp_millis multiplies by 1000 and fails on overflow.
_MAX_MILLIS = (2**63 - 1) // 1000


def epoch_ms_to_timestamp(value: Column) -> Column:
    """Timestamp of an epoch-millisecond string; NULL where it is none."""
    millis = value.try_cast("bigint")
    return F.when(millis.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis))


def parse_datetime(value: Column) -> Column:
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss"))


def partition_date(ts: Column, days_back: int = 8) -> Column:
    """``yyyyMMdd`` of the day ``days_back`` days earlier."""
    return F.date_format(F.date_sub(F.to_date(ts), days_back), "yyyyMMdd")
