"""A set of row numbers as a bitmap of fixed size: it may hold more than was put in, never less."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 22


def bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITS)).cast("int")


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """The bits of all values of ``column``."""
    found = np.zeros(BITS, bool)
    found[rows.select(bit(column).alias("bit")).distinct().toArrow().column("bit").to_numpy()] = True
    return found
