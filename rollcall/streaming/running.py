"""A running count with one row for each record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ordered import running_count
from ..sinks.upsert_table import UpsertTable


class RunningCount:
    """Counts of keys that go on from batch to batch, and a numbered row for each record.

    The records of a batch are numbered in order of time by the batch operator, which spreads a frequent key over tasks, and
    the count of its key in all batches before is added. That count is one row per key in an upsert table, written after the
    numbered rows. A batch that is run again reads the counts as they were before it and replaces its own rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[StructField], name: str = "n") -> None:
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.keys = [k.name for k in keys]
        # A NULL is a key as well: what is stored is the key as one struct.
        schema = StructType([StructField("key", StructType(list(keys)), False), StructField(name, LongType())])
        self.totals = UpsertTable(spark, f"{self.path}/totals", schema, ["key"])

    def number(self, rows: DataFrame, batch_id: int, ts: str, tie: Sequence[str], slice_size: str = "10 minutes") -> None:
        before = self.totals.read(before=batch_id).withColumnRenamed(self.name, "_before")
        counted = running_count(rows, self.keys, ts, tie, self.name, slice_size).withColumn("key", F.struct(*self.keys))
        both = counted.join(before, "key", "left").withColumn(self.name, F.col(self.name) + F.coalesce("_before", F.lit(0)))
        out = f"{self.path}/rows/batch_id={batch_id}"
        both.drop("_before", "key").write.mode("overwrite").parquet(out)
        written = self.spark.read.schema(both.drop("_before", "key").schema).parquet(out)
        self.totals.upsert(written.select(F.struct(*self.keys).alias("key"), self.name), batch_id, [self.name])

    def read(self, schema: StructType) -> DataFrame:
        """The numbered rows; ``schema`` is that of the records."""
        full = StructType([*schema.fields, StructField(self.name, LongType()), StructField("batch_id", LongType())])
        return self.spark.read.schema(full).parquet(f"{self.path}/rows").drop("batch_id")


def start_running_count(
    records: DataFrame, counts: RunningCount, checkpoint: str, ts: str, tie: Sequence[str],
    *, every: str | None = None, compact_after: int = 500, slice_size: str = "10 minutes",
) -> StreamingQuery:
    """Number every record of the stream within its key. Records of later batches come after those of earlier ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts.totals.keep_small(compact_after, before=batch_id)
        counts.number(batch, batch_id, ts, tie, slice_size)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
