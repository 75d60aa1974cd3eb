"""The mix against rankings by hand, and how near it comes to its targets."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from rollcall.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target string, u int, `a-b` int"


def table(spark, rows, parts: int = 3):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(parts)


def prose(words: int) -> str:
    return " \t".join(["w"] * words)


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what stops at its most is taken out, and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = share * sum(sizes.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not over:
            return found | {s: left * weight[s] / whole for s in open_}
        for s in over:
            found[s] = most * sizes[s]
            open_.discard(s)
        left -= sum(most * sizes[s] for s in over)
    return found


def mix_by_hand(rows):
    docs, numbers = [], {}
    for i, text, source in rows:
        size = len([w for w in (text or "").encode().split()])
        key = (source, i, size)
        numbers[key] = numbers.get(key, 0) + 1
        name = "|".join(("1", source or "", "" if i is None else str(i), str(size), str(numbers[key])))
        docs.append((source, i, size, (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52))
    sizes = {}
    for source, _, size, _ in docs:
        sizes[source] = sizes.get(source, 0) + size
    result = []
    for source, target in targets_by_hand(sizes).items():
        own, whole = [d for d in docs if d[0] == source], sizes[source]
        copies = math.floor(target / whole) if whole else 0
        rest = target - copies * whole
        extra, missed = set(), 0.0
        long = max(1, math.ceil(rest / 8))
        counting = sum(min(d[2], long) for d in own)
        for n in range(4):
            def length(size):
                return next((k for k, part in enumerate((8, 64, 512)) if size * part > rest), 3)

            some = [(k, d) for k, d in enumerate(own) if d[2] and rest > 0 and length(d[2]) == n]
            budget = max(0.0, missed + sum(min(d[2], long) for _, d in some) * rest / max(1, counting))
            chance = lambda d: min(rest / counting, 1023 / 1024) * min(1.0, long / d[2])
            some.sort(key=lambda x: (x[1][3] / (1 - x[1][3]) / (chance(x[1]) / (1 - chance(x[1]))), x[1][3]))
            run, took = 0, 0
            for k, d in some:
                run += d[2]
                if 2 * run - d[2] < 2 * budget:
                    extra.add(k)
                    took += d[2]
            missed = budget - took
        result += [(source, d[1], d[2], whole, round(float(target), 6), copies + (k in extra), (copies + (k in extra)) * d[2]) for k, d in enumerate(own)]
    return result


def awkward(seed: int):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd.choice((1, 3, 20, 50, 80, 400))), rnd.choice(["a", "B", "é", None, "z", ""])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, " \n", "blank"), (1003, prose(3_000), "B"), (1004, prose(2), "one"),
             (5, prose(4), "a"), (5, prose(4), "a"), (5, prose(4), "a"), (None, prose(9), None), (None, prose(9), None)]
    return rows


@pytest.mark.parametrize("seed, parts", [(1, 3), (1, 7), (2, 1)])
def test_the_heads_of_the_rankings(spark, seed, parts):
    rows = awkward(seed)
    found = [(r.source, r.id, r.size, r.source_size, round(r.target, 6), r.copies, r.taken) for r in mixing.mix(table(spark, rows, parts)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, mix_by_hand(rows)))


def test_a_hot_source_comes_near_its_target(spark):
    rnd = random.Random(7)
    rows = [(i, prose(int(rnd.paretovariate(1.1)) % 2_000 + 1), "hot" if i % 3 else f"s{i % 9}") for i in range(4_000)]
    taken, target = {}, {}
    copies = []
    for r in mixing.mix(table(spark, rows)).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        copies.append(r.copies)
    assert set(copies) <= {0, 1, 2}
    assert all(abs(taken[s] - target[s]) <= 0.002 * target[s] + 1 for s in target), (taken, target)


def test_weights_of_a_table(spark):
    rows = [(i, prose(10), "ab"[i % 2]) for i in range(200)]
    weights = spark.createDataFrame([("a", 3.0)], "source string, weight double")
    found = mixing.mix(table(spark, rows), weights=weights, share=0.25).groupBy("source").sum("taken").collect()
    assert {r.source: r[1] for r in found} == {"a": 500, "b": 0}


def test_an_empty_table(spark):
    assert mixing.mix(table(spark, [])).collect() == []
    assert [tuple(r) for r in mixing.mix(table(spark, [(1, None, None)])).collect()] == [(None, 1, 0, 0, 0.0, 0, 0)]
