"""Conversation repair against trying all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from rollcall.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, audit string, place int, `a-b` string"


def table(spark, rows, parts: int = 3):
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(parts)


def described_by_hand(rows):
    """rows: (turn, role, text) in order. (gaps, blank, duplicate, truncated, illegal), letters."""
    seen, counts, letters, illegal, before = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, [], 0, None
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
        before = role[:1]
        letters.append((role[:1], fault))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts.values(), illegal), letters


def mended_by_hand(letters):
    """(cost, audit) by a search over all edits, the cheapest first and then the one that is first in ASCII order."""
    heap, best = [(0, "", 0, "")], {}
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        grammar = roles[0] == "s" if roles else False
        key = (at, roles[-1:], grammar and len(roles) == 1)
        if key in best and best[key] < (cost, audit):
            continue
        best[key] = (cost, audit)
        if at == len(letters) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        fits = lambda r: re.fullmatch("s?(ua)*u?", r)
        for role in "ua":
            if fits(roles + role):
                heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role))
        if at < len(letters):
            initial, fault = letters[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if fault in (None, "truncated"):
                more = 5 * (fault == "truncated")
                if initial in tuple("sua") and fits(roles + initial):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + initial))
                for role in "ua":
                    if fits(roles + role):
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, roles + role))
    raise AssertionError


def applied_by_hand(rows, audit):
    out, at, full = [], 0, {"u": "user", "a": "assistant"}
    for edit in audit:
        wanted = full["a" if out and out[-1][0][:1] == "u" else "u"]
        if edit == "I":
            out.append((wanted, ""))
            continue
        _, role, text = rows[at]
        at += 1
        if edit != "D":
            out.append((role if edit == "K" else wanted, text))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def repair_by_hand(given):
    conversations_of = {}
    for name, turn, role, text in given:
        conversations_of.setdefault(name, []).append((turn, " " if role is None else role, " " if text is None else text))
    found = {}
    for name, rows in conversations_of.items():
        rows = ordered(rows)
        figures, letters = described_by_hand(rows)
        cost, audit = mended_by_hand(letters)
        found[name] = (*figures, cost, audit, applied_by_hand(rows, audit))
    return found


def awkward(seed: int, count: int):
    rnd = random.Random(seed)
    texts = ["One.", "Two!", "Three?  \n", "no end", "", " \t", "ü.", None, "x" * 5_000 + ".", "One."]
    rows = []
    for name in range(count):
        for turn in range(rnd.randrange(0, 7)):
            place = rnd.choice([turn, turn, turn + 3, None])
            rows.append((None if name == 3 else name, place, rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]),
                         rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_the_cheapest_edits(spark, seed):
    given = awkward(seed, 60)
    report, rows = conversations.repair(conversations.prepared(table(spark, given)))
    expected = repair_by_hand(given)
    found = {r.id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in report.collect()}
    assert found == {k: v[:-1] for k, v in expected.items()}
    kept = {}
    for r in sorted(rows.collect(), key=lambda r: r.place):
        kept.setdefault(r.id, []).append((r.role, r.text))
    assert kept == {k: v[-1] for k, v in expected.items() if v[-1]}
    sums = {r.id: r.sha256 for r in conversations.digests(rows).collect()}
    assert sums == {k: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in v).encode()).hexdigest() for k, v in kept.items()}


def test_every_signature_of_few_rows():
    import itertools

    suffixes = conversations.Suffixes()
    kinds = {"d": ("u", "blank"), **{r: (r, None) for r in "suax"}, **{r.upper(): (r, "truncated") for r in "suax"}}
    words = sorted("".join(w) for n in range(5) for w in itertools.product(kinds, repeat=n))
    for backwards in words:
        assert suffixes.solve(backwards) == mended_by_hand([kinds[c] for c in reversed(backwards)]), backwards


def test_a_conversation_with_most_of_the_rows(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(20_000)] + [(2, 0, "user", "Alone.")]
    report, mended = conversations.repair(conversations.prepared(table(spark, rows)))
    assert {r.id: (r.cost, len(r.audit)) for r in report.collect()} == {1: (0, 20_000), 2: (2, 1)}
    assert mended.where("id = 1").count() == 20_000


def test_damage_is_planted_by_name(spark):
    given = [(c, t, "assistant", f"A. {c} {t}?") for c in range(40) for t in (0, 1, None)] + [(None, 5, None, None)]
    expected = []
    for c, t, role, text in given:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        expected += [(c, t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    found = conversations.damaged(table(spark, given)).collect()
    assert sorted(map(repr, (tuple(r)[:4] for r in found))) == sorted(map(repr, expected))


def test_names_without_rows_and_an_empty_table(spark):
    none = table(spark, [])
    names = spark.createDataFrame([(1,), (None,), (1,)], "id long")
    report, rows = conversations.repair(conversations.prepared(none), names)
    assert sorted(map(repr, map(tuple, report.collect()))) == sorted(map(repr, [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, None)]))
    assert rows.collect() == [] and conversations.digests(rows).collect() == []
    report, rows = conversations.repair(conversations.prepared(none))
    assert report.collect() == [] and rows.collect() == []
