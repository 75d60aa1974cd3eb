"""Keys built from member ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def md5_hex(value: Column) -> Column:
    """MD5 as 32 lower-case hex digits."""
    return F.md5(value.cast("string"))


def salted_row_key(uid: Column, dn: Column) -> Column:
    """Row key of the wide table: five digits of md5(uid), then uid, then dn."""
    return F.concat(F.substring(md5_hex(uid), 1, 5), uid.cast("string"), dn)


def composite_key(*parts: Column) -> Column:
    """``a_b`` as stored in the dimension tables; NULL when a part is NULL."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)
