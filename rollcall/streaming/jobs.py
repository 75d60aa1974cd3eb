"""The streaming jobs. Each takes streams and starts queries with a checkpoint of their own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import json_text
from ..operators.joins import WINDOW, join_member_facts, without_event_time
from ..operators.lookup import dead_letters
from ..operators.routing import dimension_records, json_records, second_layer
from ..operators.words import POISON, count_words, fail_on, labelled_counts, words_on_space
from ..plans.member_wide import collapsed_streams, enrich, upsert_members, with_each_id
from ..plans.ods import upsert_dimensions
from ..sinks.topic_log import topic_stream, write_text_topic
from ..sinks.upsert_table import CellTable, UpsertTable
from .starting import start

WORD_COUNTS = StructType([StructField("word", StringType()), StructField("n", LongType())])


def start_fact_stream(
    log: DataFrame, checkpoint: str, *, servers: str | None = None, path: str | None = None, every: str | None = None,
) -> StreamingQuery:
    """Fact records of the raw log to the topics of the second layer."""
    return start(topic_stream(second_layer(log), checkpoint, servers=servers, path=path), log.sparkSession, every)


def start_dimension_stream(
    log: DataFrame, tables: Mapping[str, UpsertTable], checkpoint: str,
    *, every: str | None = None, compact_after: int = 50,
) -> StreamingQuery:
    """Dimension records of the raw log (with order of arrival) into their tables.

    The tables are folded every ``compact_after`` batches, and what that leaves behind is deleted.

    Give the source the dimension topics only: then neither stream reads what
    the other one needs.
    """
    records = dimension_records(json_records(log))

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_dimensions(batch, batch_id, dict(tables))
        for table in tables.values():
            table.keep_small(compact_after)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(writer, records.sparkSession, every)


def start_member_stream(
    member: DataFrame, regtype: DataFrame, payment: DataFrame,
    dimensions: Mapping[str, UpsertTable], wide: CellTable, checkpoint: str,
    *, dead_letter_path: str | None = None, size: str = WINDOW, every: str | None = None, compact_after: int = 500,
) -> StreamingQuery:
    """Join the three streams, look up the dimensions as they are now, keep the wide table current.

    The streams come with event time and watermark. Rows with a failed lookup
    are written like all others, and their keys to ``dead_letter_path`` as well.
    Records without an event time are in no window: see ``start_untimed_stream``.
    The wide table is folded every ``compact_after`` batches.
    """
    joined = join_member_facts(member, regtype, payment, size=size).drop("win")

    def write(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich(
            batch, dimensions["dwd_basead"].read(), dimensions["dwd_basewebsite"].read(),
            dimensions["dwd_membervip"].read(),
        )
        if dead_letter_path is None:
            upsert_members(enriched, batch_id, wide)
            wide.keep_small(compact_after)
            return
        # Two writes: keep the batch, so that the join is not run for each of them.
        enriched.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            upsert_members(enriched, batch_id, wide)
            dead_letters(enriched).write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
        finally:
            enriched.unpersist()
        wide.keep_small(compact_after)

    writer = joined.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(writer, joined.sparkSession, every)


def start_collapsed_member_stream(
    member: DataFrame, regtype: DataFrame, payment: DataFrame,
    dimensions: Mapping[str, UpsertTable], wide: CellTable, checkpoint: str,
    *, dead_letter_path: str | None = None, size: str = WINDOW, every: str | None = None, compact_after: int = 500,
) -> StreamingQuery:
    """The same wide table without the pairs, whose number grows with the square of a member's rows.

    See ``collapsed_streams``. Rows come out when their window has closed. Dead letters name the failed keys
    of a window; an id that is NULL is none.
    """
    joined = collapsed_streams(member, regtype, payment, size=size)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            enriched = enrich(
                with_each_id(batch), dimensions["dwd_basead"].read(), dimensions["dwd_basewebsite"].read(),
                dimensions["dwd_membervip"].read(),
            )
            upsert_members(enriched, batch_id, wide)
            if dead_letter_path is not None:
                known = F.col("ad_hit") | F.col("ad_id").isNull()
                letters = dead_letters(enriched.withColumn("ad_hit", known)).distinct()
                letters.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
        wide.keep_small(compact_after)

    writer = joined.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(writer, joined.sparkSession, every)


def start_untimed_stream(
    sides: Mapping[str, DataFrame], path: str, checkpoint: str, *, ts: str = "ts", every: str | None = None,
) -> StreamingQuery:
    """Records without a readable event time, which no window takes, as (side, value) with the record as JSON.

    Give it the streams by name; it reads them once more, so that nothing is lost without a trace.
    """
    untimed = [without_event_time(rows, ts).drop(ts) for rows in sides.values()]
    letters = reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("side"), json_text(*rows.columns).alias("value")) for name, rows in zip(sides, untimed)])
    writer = letters.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return start(writer, letters.sparkSession, every)


def start_word_count(
    lines: DataFrame, counts: UpsertTable, checkpoint: str,
    *, topic: str | None = None, topic_path: str | None = None, servers: str | None = None,
    poison: str | None = POISON, every: str | None = None, compact_after: int = 500,
) -> StreamingQuery:
    """Running count of words. The changed counts of each batch go to a table and, as text, to a topic.

    A poisoned word fails the query. Started again on the same checkpoint it goes
    on from the last finished batch.
    """
    words = words_on_space(lines)
    running = count_words(fail_on(words, poison) if poison else words)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts.upsert(batch, batch_id, ("n",))
            if topic:
                write_text_topic(labelled_counts(batch), topic, batch_id, servers=servers, path=topic_path)
        finally:
            batch.unpersist()
        counts.keep_small(compact_after)

    writer = running.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(writer, running.sparkSession, every)


def fan_out(
    outputs: Mapping[str, Column], path: str,
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: write each named selection of a batch to its own folder; a replay replaces its batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, condition in outputs.items():
                batch.where(condition).write.mode("overwrite").parquet(f"{path}/output={name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
