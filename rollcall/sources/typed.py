"""JSON records as typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions import target_topic
from ..schemas import (
    MEMBER, MEMBER_TOPIC, PAYMENT, PAYMENT_TOPIC, REGTYPE, REGTYPE_TOPIC, wire_schema,
)


def decode(
    records: DataFrame,
    schema: StructType,
    value: str = "value",
    keep: Iterable[str] = (),
    bad_fields: str | None = None,
) -> DataFrame:
    """Parse ``value`` into the columns of ``schema``.

    Every field is read as a string first, since ids may come as ``"12"`` or
    ``12``; a field that does not fit its type becomes NULL. ``bad_fields``
    names a column that counts those, so that they can be watched or set aside.
    """
    keep = list(keep)
    parsed = records.select(*keep, F.from_json(F.col(value), wire_schema(schema)).alias("_record"))
    columns = [f"try_cast(_record.`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    if bad_fields:
        failed = [
            f"CAST(_record.`{f.name}` IS NOT NULL AND "
            f"try_cast(_record.`{f.name}` AS {f.dataType.simpleString()}) IS NULL AS int)"
            for f in schema if f.dataType.typeName() != "string"
        ]
        columns.append(f"{' + '.join(failed) or '0'} AS `{bad_fields}`")
    return parsed.selectExpr(*[f"`{c}`" for c in keep], *columns)


def _of_topic(topic: str, schema: StructType):
    def read(log: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
        return decode(log.where(F.col("topic") == target_topic(F.lit(topic))), schema, keep=keep)

    read.__doc__ = f"Second-layer log to typed ``{topic}`` records."
    return read


member_records = _of_topic(MEMBER_TOPIC, MEMBER)
regtype_records = _of_topic(REGTYPE_TOPIC, REGTYPE)
payment_records = _of_topic(PAYMENT_TOPIC, PAYMENT)
