"""Shards of nearly equal bytes: a minimax contiguous partition of ordered groups.

Rows with one text are a group that stays together (NULL and empty texts are one group). Groups are ordered
by their smallest id, and the ordered groups are cut into at most ``shards`` runs so that the largest run is
as small as it can be. The smallest feasible capacity is found by binary search; a capacity is checked
greedily, by filling shard after shard up to it. Then the cuts are made: none beyond the capacity, and each
as near to an even share of what is left as that allows, so that the last shard is not the small one.

The group sizes are never gathered. The driver holds the total size up to some thousand ids, and a check
gives yes, no or not known from those. What lies between two known totals is asked for, more finely each
time, only where one of the greedy cuts can fall, until no capacity is left open.

A row's size is the UTF-8 bytes of its text plus ``overhead``. Rows with a NULL id count as smaller than all
others; groups whose smallest ids are equal are cut as one. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from rollcall.session import fresh_dir

SHARDS = 24
OVERHEAD = 8
#: Totals asked for in each stretch of ids where a cut can fall.
STEPS = 2_048
#: Rows of a shard that are numbered in one task.
ROWS_PER_CELL = 200_000
LOWEST = -(2 ** 63)


class Totals:
    """Sorted ids and the total size of all groups up to each; between neighbours without groups nothing is unknown."""

    def __init__(self, low: int, high: int, total: int) -> None:
        """The whole stretch of ids is a power of two wide, so that halving it stays exact."""
        self.keys, self.sums = [low - 1, low - 1 + 2 ** (high - low).bit_length()], [0, total]

    def add(self, found: list[tuple[int, int]]) -> None:
        merged = dict(zip(self.keys, self.sums)) | dict(found)
        self.keys = sorted(merged)
        self.sums = [merged[k] for k in self.keys]

    def closed(self, at: int) -> bool:
        """Whether no boundary between groups can lie between the totals at and at + 1."""
        return self.sums[at] == self.sums[at + 1] or self.keys[at] + 1 == self.keys[at + 1]

    def step(self, begin: int, capacity: int) -> tuple[int, int]:
        """Bounds of the largest total not above begin + capacity at which a group ends."""
        at = bisect_right(self.sums, begin + capacity) - 1
        if at + 1 == len(self.sums):
            return self.sums[at], self.sums[at]
        return self.sums[at], self.sums[at] if self.closed(at) else min(begin + capacity, self.sums[at + 1] - 1)

    def feasible(self, capacity: int, shards: int) -> bool | None:
        """Whether greedy filling reaches the end; None where that is not known yet."""
        low = high = 0
        for _ in range(shards):
            low, high = self.step(low, capacity)[0], self.step(high, capacity)[1]
        return True if low >= self.sums[-1] else False if high < self.sums[-1] else None

    def open_stretches(self, below: int, above: int, shards: int) -> list[tuple[int, int]]:
        """Ids (after, up to) between known totals in which greedy cuts of the open capacities can fall."""
        found, low, high = set(), 0, 0
        for _ in range(shards):
            first, last = bisect_right(self.sums, low + below) - 1, bisect_right(self.sums, high + above)
            found.update(at for at in range(max(first, 0), min(last, len(self.sums) - 1)) if not self.closed(at))
            low, high = self.step(low, below)[0], self.step(high, above)[1]
        return [(self.keys[at], self.keys[at + 1]) for at in sorted(found)]


def smallest_capacity(totals: Totals, shards: int, least: int, look) -> int:
    """The smallest feasible capacity; ``look`` fetches totals inside stretches of ids."""
    below, above = least - 1, totals.sums[-1]
    while True:
        low, high = below, above
        while high - low > 1:  # the smallest capacity known to be feasible
            middle = (low + high) // 2
            low, high = (low, middle) if totals.feasible(middle, shards) else (middle, high)
        above, low = high, below
        while high - low > 1:  # the largest known not to be
            middle = (low + high) // 2
            low, high = (middle, high) if totals.feasible(middle, shards) is False else (low, middle)
        below = low
        if above - below <= 1:
            return above
        totals.add(look(totals.open_stretches(below, above, shards)))


def cuts(totals: Totals, capacity: int, shards: int, look) -> list[int]:
    """The largest id of each shard but the last: no shard above ``capacity``, and each as near to its share of the rest as that allows."""
    total = totals.sums[-1]
    while True:
        unknown: set[int] = set()

        def end(size: int, up: bool = False) -> int:
            """The last total that is at most ``size``, or the first that is at least ``size``."""
            at = bisect_right(totals.sums, size) - 1
            if at + 1 == len(totals.sums) or totals.sums[at] == size:
                return totals.sums[at]
            if not totals.closed(at):
                unknown.add(at)
                return size
            return totals.sums[at + up]

        latest = [total]  # where each shard may begin at the earliest, so that the rest still fits
        for _ in range(shards - 1):
            latest.append(end(max(0, latest[-1] - capacity), up=True))
        begin, ends = 0, []
        for left in range(shards, 1, -1):
            share = begin + (total - begin) // left
            below, above = end(share), end(share, up=True)
            nearest = below if share - below <= above - share else above
            begin = min(max(nearest, latest[left - 1]), end(min(total, begin + capacity)))
            ends.append(begin)
        if not unknown:
            return [totals.keys[bisect_left(totals.sums, e)] for e in ends]
        totals.add(look([(totals.keys[at], totals.keys[at + 1]) for at in sorted(unknown)]))


def assign(
    docs: DataFrame, shards: int = SHARDS, *, id_column: str = "doc_id", text_column: str = "text",
    overhead: int = OVERHEAD, steps: int = STEPS, rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; slots number the rows of a shard from 0."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    path = fresh_dir(spark, "shard-rows")
    docs.select(
        F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    groups_path = fresh_dir(spark, "shard-groups")
    rows.groupBy("group").agg(
        F.min(F.coalesce("doc_id", F.lit(LOWEST))).alias("key"), F.sum("size").alias("bytes")).write.parquet(groups_path)
    groups = spark.read.parquet(groups_path)
    # Groups with one smallest id (only where ids repeat) are one unit.
    units = groups.groupBy("key").agg(F.sum("bytes").alias("bytes"))
    low, high, largest, total = units.agg(F.min("key"), F.max("key"), F.max("bytes"), F.sum("bytes")).first()
    if total is None:
        return rows.selectExpr("doc_id", "size", "text_crc32", "0 AS shard", "0L AS slot")
    totals = Totals(low, high, total)

    def look(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Totals inside stretches, each a cell of its width: every cell is cut into as many finer ones."""
        finer = max(2, 1 << (steps * shards // (len(stretches) + shards)).bit_length())
        found = []
        for width in {b - a for a, b in stretches}:
            small = max(1, width // finer)
            asked = spark.createDataFrame([(Decimal((a - low + 1) // width),) for a, b in stretches if b - a == width],
                                          "cell decimal(38,0)")
            cell = lambda size: F.floor((F.col("key").cast("decimal(38,0)") - F.lit(low)) / F.lit(Decimal(size)))
            inside = groups.withColumn("cell", cell(width).cast("decimal(38,0)")).join(F.broadcast(asked), "cell")
            bins = inside.groupBy(cell(small).cast("decimal(38,0)").alias("cell")).agg(F.sum("bytes").alias("bytes"))
            sizes: dict[int, list[tuple[int, int]]] = {}
            for place, size in sorted(bins.collect()):
                at = low - 1 + int(place) * small
                sizes.setdefault((at - low + 1) // width, []).append((at, size))
            for a, b in stretches:
                running = totals.sums[bisect_left(totals.keys, a)]
                for at, size in sizes.get((a - low + 1) // width, ()) if b - a == width else ():
                    found += [(at, running), (at + small, running + size)]
                    running += size
        return found

    capacity = smallest_capacity(totals, shards, max(largest, -(-total // shards)), look)
    ends = cuts(totals, capacity, shards, look)
    shard = sum((F.col("key") > F.lit(e)).cast("int") for e in ends) if ends else F.lit(0)
    placed = rows.join(groups.select("group", shard.alias("shard")), "group").drop("group")
    return numbered(placed, rows_per_cell)


def numbered(placed: DataFrame, rows_per_cell: int) -> DataFrame:
    """``placed`` with slots: rows are dealt into cells by a hash, counted, and numbered cell by cell."""
    spark = placed.sparkSession
    path = fresh_dir(spark, "shard-placed")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    most = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    cells = max(1, -(-most // rows_per_cell))
    dealt = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)))
    in_shard = Window.partitionBy("shard").orderBy("cell")
    before = dealt.groupBy("shard", "cell").count().select(
        "shard", "cell", (F.sum("count").over(in_shard) - F.col("count")).alias("before"))
    in_cell = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return dealt.withColumn("at", F.row_number().over(in_cell)).join(before, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("at") - 1).cast("long").alias("slot"))
