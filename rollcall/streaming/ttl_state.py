"""A value per key that is forgotten some time after it was written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ordered import micros


def last_logins(
    logins: DataFrame, keys: Sequence[str], ts: str = "ts", ttl: str = "1 hour", out_of_order: str = "10 seconds",
) -> DataFrame:
    """Stream: each login and the one of its key before, in microseconds.

    The login before is NULL when it is more than ``ttl`` back; each login renews
    the stored one. Within a micro-batch logins are taken in order of time, so the result
    does not depend on how the input was cut, as long as batches come in that order; a
    login older than the stored one has none before it. State is one number per key, a
    batch holds one number per login of a key. Logins without a time are left out.
    """
    keys = list(keys)
    ttl_us = micros(ttl)
    result_schema = StructType([
        *[logins.schema[k] for k in keys], StructField("us", LongType()), StructField("previous_us", LongType())])

    def remember(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = np.sort(np.concatenate([part["us"].to_numpy(dtype=np.int64) for part in parts]))
        stored = state.get[0] if state.exists else None
        before = np.concatenate([times[:1] if stored is None else [stored], times[:-1]])
        known = (times >= before) & (times - before <= ttl_us)
        known[0] &= stored is not None
        newest = int(times[-1]) if stored is None else max(int(times[-1]), stored)
        state.update((newest,))
        state.setTimeoutTimestamp(max((newest + ttl_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        result = pd.DataFrame({"us": times, "previous_us": pd.array(before, dtype="Int64")})
        result.loc[~known, "previous_us"] = pd.NA
        for at, (name, value) in enumerate(zip(keys, key)):
            result.insert(at, name, value)
        yield result

    timed = logins.select(*keys, F.col(ts), F.unix_micros(F.col(ts)).alias("us")).where(F.col("us").isNotNull())
    return (
        timed.withWatermark(ts, out_of_order)
        .groupBy(*keys)
        .applyInPandasWithState(
            remember, result_schema, StructType([StructField("last_us", LongType())]),
            "append", GroupStateTimeout.EventTimeTimeout,
        )
    )
