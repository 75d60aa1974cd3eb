"""Shapes of the member row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions import composite_key, json_text
from ..schemas import MEMBER, WIDE_MEMBER

# The payment's amount takes the place of the member record's.
MEMBER_COLUMNS = tuple(name for name in MEMBER.fieldNames() if name != "paymoney")
REGTYPE_COLUMNS = (
    "appkey", "appregurl", "bdp_uuid", "regtype_createtime", "isranreg", "regsource", "websiteid",
)
PAYMENT_COLUMNS = ("paymoney", "siteid", "vip_id")
SENSITIVE_COLUMNS = ("password", "phone", "email", "qq")


def without_member_amount(member: DataFrame) -> DataFrame:
    return member.drop("paymoney")


def with_member_key(df: DataFrame) -> DataFrame:
    """Add the stored form of the business key, ``uid_dn``."""
    return df.withColumn("member_key", composite_key(F.col("uid"), F.col("dn")))


def blank_fill(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The given columns as strings with ``""`` for NULL, as stored by untyped consumers."""
    return df.withColumns({name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns})


def wide_row(df: DataFrame, mask: Iterable[str] = (), keep: Iterable[str] = ()) -> DataFrame:
    """The 41 columns of the member table; ``mask`` hides the text of some of them."""
    hidden = set(mask)
    unknown = hidden - set(WIDE_MEMBER.fieldNames())
    if unknown:
        raise ValueError(f"not in the wide row: {sorted(unknown)}")
    return df.selectExpr(
        *[
            f"mask(CAST(`{f.name}` AS string)) AS `{f.name}`" if f.name in hidden
            else f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in WIDE_MEMBER
        ],
        *keep,
    )


def as_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Whole rows as JSON objects, for sinks that take text."""
    return df.select(json_text(*df.columns).alias(column))
