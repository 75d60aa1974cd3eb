"""The client sink: streams that run a batch again, failing tasks, empty batches, writes without a name."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from rollcall.sinks.client_sink import client_sink
from suite.folder_client import folder_client, read_folder


@pytest.fixture
def sink(spark, tmp_path):
    spark.dataSource.register(client_sink("folder_test", folder_client(), rows=3))
    return str(tmp_path / "client")


def append(df, root, batch):
    df.write.format("folder_test").option("root", root).option("batch", batch).mode("append").save()


def test_stream_batch_run_again_counts_once(spark, sink, tmp_path):
    """The commit of the last batch is lost, as after a failure: Spark runs the batch once more under its number."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for begin in (0, 10):
        spark.range(begin, begin + 10).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("id long").parquet(folder)
        for _ in range(2):
            (stream.writeStream.format("folder_test").option("root", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start().awaitTermination())
            commits = [f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]
            last = max(commits, key=int)
            for name in (last, f".{last}.crc"):
                if os.path.exists(f"{checkpoint}/commits/{name}"):
                    os.remove(f"{checkpoint}/commits/{name}")
    assert sorted(r.id for r in read_folder(spark, sink, stream.schema).collect()) == list(range(20))


def test_repeated_null_and_empty_batches(spark, sink):
    rows = spark.createDataFrame([(1, None), (1, None), (None, "x")], "k long, v string")
    append(rows, sink, "a")
    append(rows, sink, "a")
    append(rows.where("k = 7"), sink, "b")
    found = read_folder(spark, sink, rows.schema).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, rows.collect()))
    assert sorted(os.listdir(f"{sink}/batches")) == ["a.json", "b.json"]


def test_a_failed_write_shows_nothing(spark, sink):
    bad = spark.range(0, 100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        append(bad, sink, "a")
    append(spark.range(5), sink, "a")
    assert sorted(r.id for r in read_folder(spark, sink, spark.range(0).schema).collect()) == [0, 1, 2, 3, 4]


def test_a_write_names_its_batch(spark, sink):
    with pytest.raises((AnalysisException, PySparkException), match="name the write"):
        spark.range(3).write.format("folder_test").option("root", sink).mode("append").save()
