"""Join results before a window closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.joins import WINDOW, member_side, regtype_side
from ..operators.projection import REGTYPE_COLUMNS
from ..operators.skew import PART, HotKeys, deal_streams, parts_met
from ..schemas import MEMBER_KEY
from ..sinks.upsert_table import UpsertTable
from .starting import start

_ADDED = [*REGTYPE_COLUMNS, "regtype_us"]
_RESULT = [*MEMBER_KEY, "win_us", "member_no", "regtype_no"]


def early_left_join(member: DataFrame, regtype: DataFrame, ts: str = "ts", size: str = WINDOW) -> DataFrame:
    """Each member row at once and without a match (``provisional``), each pair as soon as both rows are there.

    A table with one row per member that ignores NULLs ends up as with the full
    left join, only without waiting for the watermark. No pair is sent twice.
    Rows without a match are not withdrawn: see ``early_changes``.
    """
    left = member_side(member, ts, size)
    right = regtype_side(regtype, ts, size).select(*MEMBER_KEY, "win", *_ADDED)
    columns = [c for c in left.columns if c != "win"]
    pairs = left.join(right, [*MEMBER_KEY, "win"]).select(
        *columns, F.unix_micros("win.start").alias("win_us"), *_ADDED, F.lit(False).alias("provisional"))
    kinds = {f.name: f.dataType for f in right.schema}
    alone = left.select(
        *columns, F.unix_micros("win.start").alias("win_us"),
        *[F.lit(None).cast(kinds[c]).alias(c) for c in _ADDED], F.lit(True).alias("provisional"))
    return alone.unionByName(pairs)


def early_changes(
    member: DataFrame, regtype: DataFrame, ts: str = "ts", size: str = WINDOW,
    record: str | None = None, hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """Stream: the changes of the left join. The last row of each result tells whether it stands or is ``withdrawn``.

    A member row comes at once, without a match and with a NULL ``regtype_no``. The first registration row of its member and
    window withdraws that result, and each registration row gives a pair. ``record`` names the column that tells
    records of a side apart; without it the hash of the record does, and identical records give one result.

    Both sides wait in state until the watermark passes their window. What withdraws is one more row on the right side,
    the first one of a key in state, so that one join gives pairs and withdrawals alike; hot keys are dealt out as in the
    other stream joins, and the first right row of a key goes to each part in use by a small join of its own. A member row too late for its window comes without a match, and stays so.
    """
    keys = [*MEMBER_KEY, "win"]
    left = member_side(member, ts, size)
    right = regtype_side(regtype, ts, size)
    left = left.withColumn("member_no", F.col(record or "member_tie"))
    right = right.withColumn("regtype_no", F.col(record or "regtype_tie")).select(*keys, *_ADDED, "regtype_no")
    kinds = {f.name: f.dataType for f in right.schema}
    own = [c for c in left.columns if c not in ("win", "member_tie", record)]
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in (*_ADDED, "regtype_no")]
    win_us = F.unix_micros("win.start").alias("win_us")

    on = keys if hot_keys is None else [*keys, PART]
    dealt, met = (left, right) if hot_keys is None else deal_streams(left, [right], keys, hot_keys)
    any_met = right.select(*keys).dropDuplicates(keys) if hot_keys is None else parts_met(dealt, right, keys)
    first = any_met.select(*on, *none, F.lit(True).alias("withdrawn"))
    either = met.select(*on, *_ADDED, "regtype_no", F.lit(False).alias("withdrawn")).unionByName(first)
    joined = dealt.join(either, on).select(*own, win_us, *_ADDED, "regtype_no", "withdrawn")
    return left.select(*own, win_us, *none, F.lit(False).alias("withdrawn")).unionByName(joined)


def early_table(spark: SparkSession, path: str, schema: StructType) -> UpsertTable:
    """The table that ``early_changes`` of this schema keep current; ``standing`` reads it."""
    return UpsertTable(spark, path, schema, _RESULT)


def start_early_table(
    changes: DataFrame, table: UpsertTable, checkpoint: str, *, every: str | None = None, compact_after: int = 500,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        table.keep_small(compact_after, before=batch_id)
        # A result that comes and goes in one batch is gone.
        table.upsert(batch, batch_id, ["withdrawn"])

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    # Rows come out when they meet, never for the watermark alone.
    return start(writer, changes.sparkSession, every, empty_batches=False)


def standing(table: UpsertTable) -> DataFrame:
    """The left join of all that has come so far."""
    return table.read().where("NOT withdrawn").drop("withdrawn", "member_no", "regtype_no")
