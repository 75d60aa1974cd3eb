"""JSON text in string columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_json_object(value: Column) -> Column:
    """True for text that is one JSON object and nothing else.

    Spark's JSON functions stop reading after the first complete value, so
    ``{"a":1} x`` would pass on its own. Wrapped into an array, only a ``]`` can
    follow the value; where there is one in the text, the value is wrapped into an
    object as well, and only white space fits both. The cheap look at the first
    character keeps most junk away from the parser.
    """
    as_element = F.json_array_length(F.concat(F.lit("["), value, F.lit("]")))
    as_field = F.json_object_keys(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return F.coalesce(
        value.rlike(r"^[ \t\r\n]*\{") & (as_element == 1) & (~value.contains("]") | as_field.isNotNull()),
        F.lit(False),
    )


def json_object(value: Column) -> Column:
    """Fields of a JSON object as a map of strings, NULL for anything else."""
    return F.when(is_json_object(value), F.from_json(value, "map<string,string>"))


def json_field(value: Column, name: str) -> Column:
    """One top-level field as a string."""
    return F.get_json_object(value, f"$['{name}']")


def json_text(*columns: str | Column) -> Column:
    """A JSON object of the given columns; NULL fields are left out."""
    return F.to_json(F.struct(*columns))
