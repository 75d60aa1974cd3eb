"""Starting streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

#: So many state partitions at least, where a cluster has not yet said how many cores it has.
LEAST_PARTITIONS = 12

_one_at_a_time = Lock()


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def start(
    writer: DataStreamWriter, spark: SparkSession, every: str | None = None, empty_batches: bool = True,
) -> StreamingQuery:
    """Run for good with a batch ``every`` so often, or once over what is there.

    Each batch opens and commits every state store of every operator, whether or not a row has come for it, and in a batch
    of a stream AQE merges no small partitions. So the partitions follow the cores, or the shuffle partitions where
    these are fewer. A stream takes the settings at its start, and a checkpoint keeps the number it began with.

    ``empty_batches=False`` is for streams of which a new watermark alone brings no rows out: state that it makes needless goes
    with the next batch that has rows.
    """
    shuffles = "spark.sql.shuffle.partitions"
    with _one_at_a_time:
        tasks = min(int(spark.conf.get(shuffles)), max(LEAST_PARTITIONS, spark.sparkContext.defaultParallelism))
        settings = {shuffles: str(tasks)}
        if not empty_batches:
            settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
        with _set(spark, settings):
            trigger = {"processingTime": every} if every else {"availableNow": True}
            return writer.trigger(**trigger).start()
