"""Dimension tables as the lookups need them: pruned and renamed.

Each takes the current rows of a table, one per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ad_dimension(table: DataFrame) -> DataFrame:
    return table.select(F.col("adid").alias("ad_id"), "dn", "adname")


def website_dimension(table: DataFrame) -> DataFrame:
    return table.select(
        "siteid", "dn", "sitename", "siteurl", "delete",
        F.col("createtime").alias("site_createtime"),
        F.col("creator").alias("site_creator"),
    )


def vip_dimension(table: DataFrame) -> DataFrame:
    return table.select(
        "vip_id", "dn", "vip_level",
        F.col("start_time").alias("vip_start_time"),
        F.col("end_time").alias("vip_end_time"),
        "last_modify_time", "max_free", "min_free", "next_level", "operator",
    )
