"""From the raw log to the second layer: fact topics and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.latest import latest_rows
from ..operators.routing import dimension_records, json_records, rows_for_table, second_layer
from ..schemas import ARRIVAL, DIMENSIONS, Dimension
from ..sinks.upsert_table import UpsertTable

ARRIVAL_ORDER = tuple(ARRIVAL.fieldNames())


def fact_log(log: DataFrame) -> DataFrame:
    """(second-layer topic, value) of the fact records."""
    return second_layer(log)


def dimension_versions(log: DataFrame, dimension: Dimension, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Every version of the rows of one dimension table."""
    return rows_for_table(dimension_records(json_records(log)), dimension, keep=tuple(order))


def dimension_rows(log: DataFrame, dimension: Dimension, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """One dimension table as the whole log leaves it."""
    latest = latest_rows(dimension_versions(log, dimension, order), dimension.key, order)
    return latest.select(*dimension.schema.fieldNames())


def dimension_table(spark: SparkSession, root: str, dimension: Dimension) -> UpsertTable:
    return UpsertTable(spark, f"{root}/{dimension.table}", dimension.schema, dimension.key)


def dimension_tables(spark: SparkSession, root: str) -> dict[str, UpsertTable]:
    return {d.table: dimension_table(spark, root, d) for d in DIMENSIONS}


def upsert_dimensions(
    log: DataFrame, batch_id: int, tables: dict[str, UpsertTable], order: Sequence[str] = ARRIVAL_ORDER,
) -> None:
    """Upsert one batch of raw records into all dimension tables. The batch is read and filtered once."""
    records = dimension_records(json_records(log)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for dimension in DIMENSIONS:
            tables[dimension.table].upsert(rows_for_table(records, dimension, keep=tuple(order)), batch_id, order)
    finally:
        records.unpersist()
