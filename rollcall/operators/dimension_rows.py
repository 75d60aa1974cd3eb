"""Rows of the dimension tables with typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions import parse_datetime


def typed_website(rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return rows.select(
        F.col("siteid").alias("site_id"), "sitename", "siteurl",
        F.col("delete").try_cast("int").alias("delete"), "createtime", "creator", "dn", *keep,
    )


def typed_ad(rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return rows.select("adid", "adname", "dn", *keep)


def typed_vip(rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return rows.select(
        "vip_id", "vip_level",
        *[parse_datetime(F.col(c)).alias(c) for c in ("start_time", "end_time", "last_modify_time")],
        "max_free", "min_free", "next_level", "operator", "dn", *keep,
    )
