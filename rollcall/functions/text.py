"""Strings: encodings, addresses, money, topic names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import SECOND_LAYER_PREFIX


def to_text(value: Column) -> Column:
    return F.decode(value, "UTF-8")


def to_bytes(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def target_topic(topic: Column) -> Column:
    """Topic of the second layer a fact record goes to."""
    return F.concat(F.lit(SECOND_LAYER_PREFIX), topic)


def ipv4(number: Column) -> Column:
    """Dotted address of a signed 32-bit number."""
    octets = [F.shiftright(number.cast("int"), bits).bitwiseAND(F.lit(255)) for bits in (24, 16, 8, 0)]
    return F.concat(
        octets[0].cast("string"), F.lit("."), octets[1].cast("string"), F.lit("."),
        octets[2].cast("string"), F.lit("."), octets[3].cast("string"),
    )


def money_text(amount: Column) -> Column:
    """Two decimals, ties to the even digit. A pattern argument gives no thousands separators."""
    return F.call_function("format_number", amount.cast("double"), F.lit("0.00"))
