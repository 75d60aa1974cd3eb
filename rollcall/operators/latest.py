"""Last write wins: per row, or per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _order(columns: Sequence[str]) -> str:
    quoted = [f"`{c}`" for c in columns]
    return quoted[0] if len(quoted) == 1 else f"struct({', '.join(quoted)})"


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. Reduced before the shuffle, so a hot key costs one row per task."""
    others = ", ".join(f"`{c}`" for c in df.columns if c not in keys)
    last = F.expr(f"max_by(struct({others}), {_order(order)}) AS _last")
    return df.groupBy(*keys).agg(last).selectExpr(
        *[f"`{c}`" if c in keys else f"_last.`{c}`" for c in df.columns]
    )


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key and column the last value that is not NULL. Reduced before the shuffle as well.

    The order columns come out as those of the last row.
    """
    when = _order(order)
    values = [
        F.expr(f"max_by(`{c}`, {when}) FILTER (WHERE `{c}` IS NOT NULL) AS `{c}`")
        for c in df.columns if c not in keys and c not in order
    ]
    last = F.expr(f"max(struct({', '.join(f'`{c}`' for c in order)})) AS _order")
    return df.groupBy(*keys).agg(*values, last).selectExpr(
        *[f"_order.`{c}`" if c in order else f"`{c}`" for c in df.columns]
    )
