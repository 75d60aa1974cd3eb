"""Connected components of links between numbers, by large-star and small-star rounds.

Each round links every node to the smallest it knows, first all its larger neighbours (large star), then all
its smaller ones (small star), until nothing changes. Nothing is gathered per node but a minimum, so a node with very
many links is no single task. Every round is written to the shared folder, and deleted when the next one is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the smallest node of its component) for every node that is in a link (a, b) and is not the root.

    The result is a table of ``scratch``.
    """
    links = scratch.store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.union(links.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.store(large.where("a <> b").distinct(), "links")
        scratch.drop(links)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
        links = scratch.store(small.where("a <> b").distinct(), "links")
        scratch.drop(large)
        before, state = state, _state(links)
        if state == before:
            break
    classes = scratch.store(links.select(F.col("a").alias("node"), F.col("b").alias("root")), "classes")
    scratch.drop(links)
    return classes
