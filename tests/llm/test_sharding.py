from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from rollcall.llm import sharding

from .helpers import awkward, docs


def smallest_by_hand(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                used, filled = used + 1, 0
            filled += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check(rows, found, shards, overhead=8):
    key, size = {}, defaultdict(int)
    for i, t in rows:
        t = t or ""
        key[t] = min(key.get(t, 2 ** 63), -(2 ** 63) if i is None else i)
        size[t] += len(t.encode()) + overhead
    units = defaultdict(int)
    for t in key:
        units[key[t]] += size[t]
    best = smallest_by_hand([units[k] for k in sorted(units)], shards)
    texts = defaultdict(set)
    filled, slots = defaultdict(int), defaultdict(list)
    by_row = defaultdict(list)
    for i, t in rows:
        by_row[i, len((t or "").encode()) + overhead, zlib.crc32((t or "").encode())].append(t or "")
    for r in found:
        t = by_row[r.doc_id, r.size, r.text_crc32].pop()
        texts[t].add(r.shard)
        filled[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert not any(by_row.values())
    assert all(len(s) == 1 for s in texts.values())
    assert max(filled.values()) == best and set(filled) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = sorted((key[t], next(iter(texts[t]))) for t in key)
    assert [s for _, s in order] == sorted(s for _, s in order)
    return filled


@pytest.mark.parametrize(("seed", "shards", "steps", "cell"), [(1, 7, 16, 5), (2, 24, 2048, 1000), (3, 5, 8, 7)])
def test_smallest_capacity_and_contiguous_cuts(spark, seed, shards, steps, cell):
    chosen = random.Random(seed)
    rows = [(chosen.randrange(3_000), chosen.choice("abcdefg") * chosen.choice((1, 10, 300, chosen.randrange(1, 900))))
            for _ in range(160)] + [(5 * i, "hot") for i in range(80)]
    found = sharding.assign(docs(spark, rows), shards, steps=steps, rows_per_cell=cell).collect()
    filled = check(rows, found, shards)
    assert len(filled) <= shards


def test_awkward_rows(spark):
    rows = awkward() + [(2 ** 40, "far"), (-(2 ** 40), "away")]
    check(rows, sharding.assign(docs(spark, rows), 4).collect(), 4)


def test_even_sizes_are_even(spark):
    rows = [(i, f"{i:08d}") for i in range(240)]
    filled = check(rows, sharding.assign(docs(spark, rows), 24).collect(), 24)
    assert set(filled.values()) == {160}


def test_fewer_groups_than_shards_and_empty(spark):
    check([(1, "a"), (2, "b")], sharding.assign(docs(spark, [(1, "a"), (2, "b")]), 24).collect(), 24)
    assert sharding.assign(docs(spark, []), 24).collect() == []
