from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string, rank int, block string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k, every):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, a in fine:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b))
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(expected)


@pytest.mark.parametrize("shard_rows", [4, 1000])
def test_best_of_all_with_ties_and_bad_vectors(spark, shard_rows):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice((-0.5, 0.25, 0.1, 1.0)) for _ in range(3)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 2.0]), (62, [1.0, math.nan, 0.0]), (63, [math.inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
             (70, [1.0, 2.0]), (80, [0.5, -2.0]), (90, [])]
    found = topk.search(table(spark, rows), F.col("vec_id") % 10 == 0, 5, block_rows=3, shard_rows=shard_rows)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 10)


def test_sums_beyond_floating_point_are_exact(spark):
    rows = [(i, [2.0 ** 20 + i / 256, 2.0 ** 22, 3.0]) for i in range(12)]
    found = topk.search(table(spark, rows), F.col("vec_id") == 0, 3)
    assert [tuple(r)[2:] for r in sorted(found.collect())] == [t[2:] for t in brute(rows, 3, 100)]


def test_components_beyond_64_bits_take_part(spark):
    rows = [(0, [2.0 ** -58, 1.0]), (1, [2.0 ** 58, 1.0]), (2, [-(2.0 ** 58), 1.0]), (3, [2.0 ** 57, 0.5]), (4, [1e308, 0.0])]
    found = topk.search(table(spark, rows), F.col("vec_id") == 0, 5)
    assert sorted(map(tuple, found.collect())) == brute(rows[:4], 5, 10)


def test_repeated_ids_and_empty_table(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (0, [5.0])]
    found = topk.search(table(spark, rows), F.col("vec_id") == 0, 5).collect()
    assert {r.vec_id for r in found} == {1} and len(found) == 4
    assert topk.search(table(spark, []), F.col("vec_id") == 0, 5).collect() == []
