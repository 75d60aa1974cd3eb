"""Raw records as (topic, value) and plain text lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schemas import ARRIVAL, RAW_LOG


def kafka_options(servers: str, topics: Iterable[str], max_per_batch: int | None = None) -> dict[str, str]:
    """Options of a Kafka source that begins at the earliest offset.

    Once a stream has a checkpoint the offsets in it win, so a restart goes on
    where the stream stopped.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_raw_log(
    spark: SparkSession,
    topics: Iterable[str],
    *,
    servers: str | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    stream: bool = True,
    max_per_batch: int | None = None,
    arrival: bool = False,
) -> DataFrame:
    """(topic, value) of the named topics, from Kafka or from a folder of files.

    Kafka is asked for the named topics only. From files the topic filter is
    pushed to the reader, and prunes directories where the folder is
    partitioned by topic. A new stream starts with the oldest data either way.
    ``arrival`` adds the order of arrival: broker time in microseconds and offset
    (files have to hold these as columns ``arrived`` and ``offset``).
    """
    topics = list(topics)
    order = ARRIVAL.fieldNames() if arrival else []
    reader = spark.readStream if stream else spark.read
    if servers:
        options = kafka_options(servers, topics, max_per_batch if stream else None)
        log = reader.format("kafka").options(**options).load()
        return log.select(
            "topic", F.col("value").cast("string").alias("value"),
            *([F.unix_micros("timestamp").alias("arrived"), "offset"] if arrival else []),
        )
    if path is None:
        raise ValueError("give servers for Kafka or path for files")
    if stream and max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    schema = StructType([*RAW_LOG.fields, *(ARRIVAL.fields if arrival else [])])
    return (
        reader.schema(schema).format(file_format).load(path)
        .where(F.col("topic").isin(topics)).select("topic", "value", *order)
    )


def read_lines(spark: SparkSession, path: str, *, stream: bool = True, max_files: int | None = None) -> DataFrame:
    """Text files as one ``line`` column."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format("text").load(path).select(F.col("value").alias("line"))
