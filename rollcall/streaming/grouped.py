"""A function over the rows of both streams that share a key and a window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.skew import PART, HotKeys, deal_streams


def cogroup_stream(
    left: DataFrame, right: DataFrame, keys: Sequence[str], function, schema: StructType | str,
    hot_keys: HotKeys | None = HotKeys(), rows_per_call: int | None = None,
) -> DataFrame:
    """Stream: ``function(left_rows, right_rows)`` for each key of the left side and window, when the window closes.

    Both sides are in windows already (``in_window``); ``keys`` are the columns besides the window ``win``, which the
    function does not get. The rows of both sides wait as one tagged stream in the state of one aggregation, which Spark keeps per key
    and window and drops when the watermark has passed the window.

    As in the batch, the function treats left rows one by one and gives nothing where there are none: then the left rows of
    a key are dealt out over several calls and the right rows repeated for them. With ``hot_keys=None`` a call gets the whole group. With
    ``rows_per_call`` a call gets the rows of many keys, and the function has to keep them apart. Rows without a whole key
    belong to no group.
    """
    sides = [side.where(" AND ".join(f"`{k}` IS NOT NULL" for k in (*keys, "win"))) for side in (left, right)]
    if hot_keys is not None:
        sides = deal_streams(sides[0], sides[1:], [*keys, "win"], hot_keys)
    else:
        sides = [side.withColumn(PART, F.lit(0)) for side in sides]
    columns = [[c for c in side.columns if c != "win"] for side in (left, right)]
    kinds = [StructType([side.schema[c] for c in names]) for side, names in zip((left, right), columns)]
    tagged = [
        side.select(*keys, "win", PART, *[
            (F.struct(*[F.col(f"`{c}`") for c in names]) if at == own else F.lit(None).cast(kind)).alias(f"_side{at}")
            for at, (names, kind) in enumerate(zip(columns, kinds))])
        for own, side in enumerate(sides)]
    groups = tagged[0].unionByName(tagged[1]).groupBy(*keys, "win", PART).agg(
        F.collect_list("_side0").alias("_left"), F.collect_list("_side1").alias("_right")).where("size(_left) > 0")
    result = to_arrow_schema(_as_struct(left, schema))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Parts of one key must not meet in a call.
            part = batch.column(PART).to_numpy()
            for number in sorted(set(part.tolist())):
                yield from _called(batch.filter(pa.array(part == number)))

    def _called(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = [batch.column(c).value_lengths().to_numpy() for c in ("_left", "_right")]
        begin, held = 0, 0
        for at in range(batch.num_rows):
            held += int(sizes[0][at] + sizes[1][at])
            if rows_per_call is None or held >= rows_per_call or at == batch.num_rows - 1:
                some = batch.slice(begin, at + 1 - begin)
                frames = [pa.Table.from_batches([pa.RecordBatch.from_struct_array(some.column(c).flatten())]).to_pandas()
                          for c in ("_left", "_right")]
                found: pd.DataFrame = function(*frames)
                yield from pa.Table.from_pandas(found, schema=result, preserve_index=False).to_batches()
                begin, held = at + 1, 0

    return groups.select(PART, "_left", "_right").mapInArrow(call, schema)


def _as_struct(df: DataFrame, schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return df.sparkSession.createDataFrame([], schema).schema
