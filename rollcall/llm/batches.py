"""Arrow batches as numpy: bytes and offsets of a text column, cut to bounded pieces."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.session import fresh_dir

from .scratch import left_behind

PIECE_BYTES = 1 << 20
#: What Spark hands to Python at once; its default is 64 MB, of which there are several copies in a worker.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Keep batches of texts small, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` with a number of each row, ``row``, from the shared folder.

    How Spark splits files may change from job to job, so numbers that are to be met again are drawn once and stored.
    """
    path = fresh_dir(df.sparkSession, label)
    left_behind(df.sparkSession, path)
    df.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` has about ``limit`` bytes; a longer text is alone in its batch."""
    for batch in batches:
        yield from _pieces(batch, column, limit)
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system: the worker lives on and waits for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        begin = 0
        ends = np.concatenate([[0], np.cumsum(lengths(batch.column(column)))])
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for NULL."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a NULL has no bytes."""
    offsets = np.concatenate([[0], np.cumsum(lengths(texts))])
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.empty(0, np.uint8), offsets
    kind = np.int64 if wide else np.int32
    starts = np.frombuffer(texts.buffers()[1], kind)[texts.offset: texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[int(starts[0]): int(starts[-1])], offsets


def binaries(parts: list[bytes | memoryview]) -> pa.Array:
    return pa.array(parts, pa.binary())
