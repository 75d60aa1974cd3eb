"""Which raw records are kept, and where they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import is_json_object, target_topic
from ..schemas import DEFAULT_ROUTE, DIMENSION_ROUTES, DIMENSION_TOPICS, Dimension
from ..sources.typed import decode


def json_records(log: DataFrame) -> DataFrame:
    """Records whose value is a JSON object."""
    return log.where(is_json_object(F.col("value")))


def is_dimension(topic: Column) -> Column:
    return F.coalesce(topic.isin(*DIMENSION_TOPICS), F.lit(False))


def dimension_records(log: DataFrame) -> DataFrame:
    return log.where(is_dimension(F.col("topic")))


def fact_records(log: DataFrame) -> DataFrame:
    """Everything that is no dimension record."""
    return log.where(~is_dimension(F.col("topic")))


def split_by_layer(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, dimensions); together they are the whole log."""
    return fact_records(log), dimension_records(log)


def target_table(topic: Column) -> Column:
    """Name of the dimension table a topic is stored in; unknown topics go to the default one."""
    name = F.lit(DEFAULT_ROUTE.table)
    for source, dimension in DIMENSION_ROUTES.items():
        name = F.when(topic == source, dimension.table).otherwise(name)
    return name


def rows_for_table(log: DataFrame, dimension: Dimension, keep: tuple[str, ...] = ()) -> DataFrame:
    """The dimension records of one table, decoded."""
    return decode(log.where(target_table(F.col("topic")) == dimension.table), dimension.schema, keep=keep)


def second_layer(log: DataFrame) -> DataFrame:
    """Fact records as (target topic, value)."""
    facts = fact_records(json_records(log))
    return facts.select(target_topic(F.col("topic")).alias("topic"), "value")
