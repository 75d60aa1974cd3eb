"""Spreading hot keys of an equi-join over several tasks without changing its result.

A key that holds a large part of the rows would end up in one task, and in a
chain of joins on the same key AQE does not split it: the second join reads the
first one, not a shuffle. So the rows of a hot key are dealt out beforehand. On
its own side a row takes one of the parts; on the other sides it is repeated for
each, so every pair still meets exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import fresh_dir

PART = "_part"


@dataclass(frozen=True)
class HotKeys:
    """A key is hot with more than ``rows_per_part`` rows on a side: so many one task may hold of it.

    A stream cannot count ahead. There the left rows of every key are dealt out over ``lanes``, and right rows are repeated
    for the lanes that its left rows are in; ``right_lanes`` spread the right rows of a key on the way there.
    """

    rows_per_part: int = 500_000
    lanes: int = 32
    right_lanes: int = 8


@dataclass(frozen=True)
class KeyCounts:
    """What one pass over the key columns tells: all rows, and the most of one side that share the beginning of the key."""

    rows: int
    most: int


def _ones(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    numbers = range(len(sides))
    return reduce(
        DataFrame.unionByName,
        [side.selectExpr(*_quoted(keys), *[f"{int(i == j)}L AS _c{j}" for j in numbers]) for i, side in enumerate(sides)],
    )


def _sums(ones: DataFrame, names: Sequence[str], numbers: range) -> DataFrame:
    return ones.groupBy(*names).agg(*[F.expr(f"sum(_c{j}) AS _c{j}") for j in numbers])


def _largest(numbers: range) -> str:
    return f"greatest({', '.join(f'_c{j}' for j in numbers)})" if len(numbers) > 1 else "_c0"


def key_counts(sides: Sequence[DataFrame], keys: Sequence[str]) -> KeyCounts:
    """One reading of the key columns, counted before the shuffle.

    A key can only be hot if what it begins with is, and that is counted: whole keys with a window occur once or twice each.
    """
    numbers = range(len(sides))
    begin = list(keys)[:-1] or list(keys)
    sums = _sums(_ones(sides, begin), begin, numbers)
    found = sums.selectExpr(f"sum({' + '.join(f'_c{j}' for j in numbers)}) AS n", f"max({_largest(numbers)}) AS most").first()
    return KeyCounts(found.n or 0, found.most or 0)


def hot_key_parts(sides: Sequence[DataFrame], keys: Sequence[str], policy: HotKeys) -> DataFrame:
    """keys, _n0, _n1, ...: in how many parts each side of a hot key is dealt out.

    Whole keys are counted for those only whose beginning has enough rows.
    """
    numbers = range(len(sides))
    counted = _ones(sides, keys)

    def hot(names: Sequence[str]) -> DataFrame:
        return _sums(counted, names, numbers).where(f"{_largest(numbers)} > {policy.rows_per_part}")

    begin = list(keys)[:-1]
    if begin:
        counted = counted.join(_stored(hot(begin).select(*begin)), begin, "left_semi")
    return hot(keys).selectExpr(
        *keys, *[f"CAST(greatest(1, ceil(_c{j} / {policy.rows_per_part})) AS int) AS _n{j}" for j in numbers])


def _stored(df: DataFrame) -> DataFrame:
    """Written and read again, so that Spark knows how large it is and chooses the join by that."""
    path = fresh_dir(df.sparkSession, "hot-keys")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def row_hash(columns: Sequence[str]) -> str:
    return f"xxhash64({', '.join(_quoted(columns))})"


def _own_part(columns: Sequence[str], parts: str) -> str:
    # The input partition goes into the hash so that equal rows spread as well.
    # It does not depend on the order of rows, so a repeated task deals alike.
    return f"pmod(xxhash64(spark_partition_id(), {', '.join(_quoted(columns))}), {parts})"


def spread(
    sides: Sequence[DataFrame], keys: Sequence[str], policy: HotKeys, counted: Sequence[DataFrame] | None = None,
    counts: KeyCounts | None = None,
) -> list[DataFrame] | None:
    """The sides with a ``_part`` column to be joined on together with the keys; None if no key is hot.

    Where no key is hot this takes one reading of the key columns, or none if ``counts`` of the sides are known.

    The list of hot keys holds at most (rows of all sides) / ``rows_per_part`` keys and
    is joined by whatever Spark chooses for its size. Where that is a shuffle, AQE can
    split the hot key's rows, which stand on the other side of that join.

    Side 0 is the left side of left joins. It also gets ``_split1``, ``_split2``, ...:
    whether the key is dealt out on that side. A copy of such a left row that finds
    nothing in its part has its matches in another part and is to be dropped.

    ``counted`` gives frames with the same keys that are cheaper to count, where
    the sides already hold the work of one-to-one lookups.
    """
    numbers = range(len(sides))
    counts = counts or key_counts(counted or sides, keys)
    if counts.most <= policy.rows_per_part:
        return None
    hot = _stored(hot_key_parts(counted or sides, keys, policy))
    if hot.isEmpty():
        return None
    sizes = [f"coalesce(_n{j}, 1) AS _n{j}" for j in numbers]
    result = []
    for i, side in enumerate(sides):
        columns = _quoted(side.columns)
        own = _own_part(side.columns, f"coalesce(_n{i}, 1)")
        dealt = side.join(hot, list(keys), "left").selectExpr(*columns, *sizes, f"CAST({own} AS int) AS _d{i}")
        for j in numbers:
            if j != i:
                others = f"explode(IF(_n{j} > 1, sequence(0, _n{j} - 1), array(0))) AS _d{j}"
                dealt = dealt.selectExpr("*", others)
        part = "_d0"
        for j in numbers[1:]:
            part = f"({part}) * _n{j} + _d{j}"
        flags = [f"_n{j} > 1 AS _split{j}" for j in numbers[1:]] if i == 0 else []
        result.append(dealt.selectExpr(*columns, f"{part} AS {PART}", *flags))
    return result


def _whole(keys: Sequence[str]) -> str:
    return " AND ".join(f"`{k}` IS NOT NULL" for k in keys)


def _notices(dealt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream: each whole key and part of the left rows once, as soon as it is in use."""
    return dealt.where(_whole(keys)).select(*keys, PART).dropDuplicates([*keys, PART])


def parts_met(dealt: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream: keys and part, once for each part in use of a key that has a right row.

    Both sides come once for each key, so this takes no lanes.
    """
    return _notices(dealt, keys).join(right.select(*keys).dropDuplicates(list(keys)), list(keys))


def deal_streams(
    left: DataFrame, rights: Sequence[DataFrame], keys: Sequence[str], policy: HotKeys, event_time: str = "win",
) -> list[DataFrame]:
    """Streams with a ``_part`` column to be joined on together with the keys; a left row has exactly one part.

    Each left row takes the part its own hash gives. The first one of a key and part is a notice, kept in state until the
    watermark passes ``event_time``, which is one of the keys. Right rows meet the notices of their key in state: a right row goes out
    once for every part that is in use, at once where the notice is there already, and later where it comes later. A key
    with few left rows has few parts, so there are no more copies than pairs. Notices stand once in every
    right lane, and right rows are dealt over these, so a frequent key is spread on the way as well.
    """
    part = f"CAST(IF({_whole(keys)}, pmod(xxhash64({', '.join(_quoted(left.columns))}), {policy.lanes}), 0) AS int) AS {PART}"
    dealt = left.selectExpr("*", part)
    lanes = _notices(dealt, keys).selectExpr("*", f"explode(sequence(0, {policy.right_lanes - 1})) AS _lane")
    result = [dealt]
    for right in rights:
        lane = f"CAST(pmod(xxhash64({', '.join(_quoted(right.columns))}), {policy.right_lanes}) AS int) AS _lane"
        met = right.selectExpr("*", lane).join(lanes, [*keys, "_lane"])
        result.append(met.select(*right.columns, PART))
    return result
