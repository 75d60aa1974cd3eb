"""Sessions by the time at which records arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.windows import session_counts
from ..schemas import ARRIVAL


def arrival_sessions(
    records: DataFrame, keys: Sequence[str], gap: str = "5 seconds", arrived: str = ARRIVAL.fieldNames()[0],
    out_of_order: str = "0 seconds",
) -> DataFrame:
    """Stream: ``win`` and count of each run of records of a key that arrive no more than ``gap`` apart.

    ``arrived`` holds epoch microseconds as the log gives them, so a run repeated from a checkpoint finds the same sessions,
    which the clock of the reader would not. A session comes when records have arrived ``out_of_order`` after its end.

    With the session's settings each task merges its own records into sessions before the shuffle, so a
    frequent key sends a row for each task and session rather than one for each record.
    Records without an arrival time are in no session.
    """
    timed = records.withColumn("_arrived", F.timestamp_micros(arrived)).withWatermark("_arrived", out_of_order)
    return session_counts(timed, keys, "_arrived", gap)
