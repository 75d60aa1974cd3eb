"""Hard negatives against scoring every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score string, `a-b` int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", "y", 1) for i, v, k in rows], SCHEMA).repartition(3)


def brute(rows, every, most=5, need=10, low=30, high=90):
    fine = [(i, [math.floor(256 * x) for x in v], k) for i, v, k in rows
            if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for i, a, k in fine:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, l) for j, b, l in fine if j != i and len(a) == len(b)]
        for p, pid, _ in sorted((s for s in scored if s[2] == k), key=lambda s: s[:2])[:most]:
            window = sorted((s, j) for s, j, l in scored if l != k and low * -p <= 100 * -s <= high * -p)
            expected += [(i, pid, n, j, -p, -s) for n, (s, j) in enumerate(window[:need], 1)]
    return sorted(expected)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("shard_rows, block_rows, dims", [(7, 3, 20), (1000, 1000, 3)])
def test_windows_of_every_positive(spark, shard_rows, block_rows, dims):
    rnd = random.Random(dims)
    # Later dimensions weigh less, so that lists leave some of them out; many rows are equal.
    draw = lambda: [rnd.choice((-0.5, 0.25, 0.1, 1.0)) / (1 + d) for d in range(dims)]
    rows = [(i, draw(), rnd.randrange(4)) for i in range(150)]
    rows += [(200 + i, rows[0][1], 0) for i in range(30)] + [(300 + i, rows[0][1], 1) for i in range(30)]
    rows += [(1000, None, 1), (1001, [1.0, None], 1), (1002, [math.nan] * dims, 1), (1010, [math.inf] * dims, 1), (1020, draw(), None),
             (None, draw(), 1), (1030, [1.0], 1), (1040, [], 2), (1050, [], 2), (1060, [0.0] * dims, 3), (10, draw(), 2)]
    got = negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_rows=block_rows)
    assert found(got) == brute(rows, 10)


def test_lists_leave_dimensions_out_and_lose_no_pair():
    rnd = np.random.default_rng(3)
    values = np.floor(256 * rnd.normal(size=(500, 32)) / (1 + np.arange(32)))
    queries = np.floor(256 * rnd.normal(size=(40, 32)) / (1 + np.arange(32)))
    least = 0.6 * np.sqrt((queries ** 2).sum(1)) * np.median(np.sqrt((values ** 2).sum(1)))
    index = negatives.Index(np.arange(500), np.zeros(500), values, float((least / np.sqrt((queries ** 2).sum(1))).min()))
    assert index.kept.max() < 32 and index.kept.min() < index.kept.max()
    query, row, score = index.pairs(queries, least)
    exact = queries @ values[index.ids].T
    assert (exact[query, row] == score).all()
    assert set(zip(*np.nonzero(exact >= least[:, None]))) <= set(zip(query, row)) and len(query) < exact.size / 4


def test_sums_beyond_floating_point_are_exact(spark):
    rows = [(i, [2.0 ** 22 + i / 256, 2.0 ** 19 * (1 + i % 3), 3.0], i % 2) for i in range(40)]
    got = negatives.mine(table(spark, rows), F.col("vec_id") == 0, low=1, high=120)
    assert found(got) == brute(rows, 100, low=1, high=120) != []
    # Components past 64 bits: nothing is lost or crashes.
    rows = [(0, [2.0 ** 60], 0), (1, [2.0 ** 60], 0), (2, [2.0 ** -60], 1)]
    assert found(negatives.mine(table(spark, rows), F.col("vec_id") == 0, low=0)) == [(0, 1, 1, 2, 2 ** 63 - 1, 0)]


def test_no_positives_no_rows_and_an_empty_table(spark):
    assert found(negatives.mine(table(spark, [(0, [1.0], 1), (1, [1.0], 2)]), F.col("vec_id") == 0)) == []
    assert found(negatives.mine(table(spark, []), F.col("vec_id") == 0)) == []
    assert found(negatives.mine(table(spark, [(0, [1.0], 1), (0, [1.0], 1), (1, [-1.0], 1), (3, [0.5], 2)]), F.col("vec_id") == 0)) == []
