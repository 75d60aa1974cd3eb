"""Fact records and text lines written to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.routing import second_layer


def write_topic_log(log: DataFrame, path: str) -> None:
    """Batch: (topic, value) below one folder per topic. No shuffle: each task writes its own topics."""
    log.select("topic", "value").write.mode("append").partitionBy("topic").parquet(path)


def append_facts(log: DataFrame, path: str) -> None:
    """Batch: the fact records of a raw log under their second-layer topics."""
    write_topic_log(second_layer(log), path)


def topic_stream(log: DataFrame, checkpoint: str, *, servers: str | None = None, path: str | None = None) -> DataStreamWriter:
    """Stream: each (topic, value) to the topic it names, with no key.

    The file form is exactly-once through the sink's own log, and a stream that
    reads the folder honours that log. Kafka gets each record at least once.
    """
    writer = log.select("topic", "value").writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers)
    if path is None:
        raise ValueError("give servers for Kafka or path for files")
    return writer.format("parquet").partitionBy("topic").option("path", path)


def write_text_topic(
    lines: DataFrame, topic: str, batch_id: int, *, servers: str | None = None, path: str | None = None,
) -> None:
    """Lines of one micro-batch to one fixed topic; for ``foreachBatch``, so that update mode will do."""
    values = lines.select(F.col("value").cast("string").alias("value"))
    if servers:
        values.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        values.write.mode("overwrite").parquet(f"{path}/topic={topic}/batch_id={batch_id}")
