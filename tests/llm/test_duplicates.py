from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import components, decontaminate, jaccard, substring
from rollcall.llm.scratch import Scratch

from .helpers import awkward, docs, prose, stored

BIG = 2 ** 63


def kept_by_hand(rows, window):
    first = {}
    words = [(BIG if i is None else i, (t or "").encode().split()) for i, t in rows]
    for key, own in words:
        for at in range(len(own) - window + 1):
            name = tuple(own[at: at + window])
            first[name] = min(key, first.get(name, BIG))
    result = []
    for (doc_id, _), (key, own) in zip(rows, words):
        gone = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at: at + window])] < key:
                gone.update(range(at, at + window))
        result.append((doc_id, len(own), len(gone), b" ".join(w for n, w in enumerate(own) if n not in gone).decode()))
    return sorted(map(repr, result))


def passages(seed, count):
    """Texts that share passages, with a third of them copies of one text."""
    chosen = random.Random(seed)
    shared = [prose(1000 + n, 30, 500) for n in range(4)]
    rows = []
    for i in range(count):
        parts = [prose(seed * 7919 + i, chosen.randrange(5, 60), 500)]
        if chosen.random() < 0.6:
            parts.insert(chosen.randrange(2), chosen.choice(shared))
        rows.append((i * 3 % count, " \n".join(parts) if i % 3 else prose(5, 90, 500)))
    return rows


@pytest.mark.parametrize("per_bucket", [substring.PER_BUCKET, 40])
@pytest.mark.parametrize("window", [13, 4])
def test_substring_dedup_by_brute_force(spark, per_bucket, window):
    """With small buckets most minimisers are hot and their windows are dealt one by one."""
    rows = awkward() + [(100 + i, t) for i, t in passages(2, 60)]
    given = stored(spark, docs(spark, rows))
    found = substring.dedupe(given, window=window, per_bucket=per_bucket)
    assert found.select("doc.*").columns == given.columns
    got = [(r.doc.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()]
    assert sorted(map(repr, got)) == kept_by_hand(rows, window)


def test_long_run_is_cut(spark, monkeypatch):
    monkeypatch.setattr(substring, "LONGEST", 7)
    rows = [(1, "a " * 90), (2, "b c " * 60 + "a " * 30), (3, "a " * 20)]
    found = substring.dedupe(stored(spark, docs(spark, rows)))
    assert sorted(repr((r.doc.doc_id, r.n_words, r.n_removed, r.kept)) for r in found.collect()) == kept_by_hand(rows, 13)


def test_equal_hashes_are_told_apart(monkeypatch):
    import numpy as np

    class Blind(substring.Hasher):
        def hashes(self, data, starts, ends):
            return np.zeros(len(starts), np.uint64)

    monkeypatch.setattr(substring, "hasher", Blind)
    texts = [b"a b c d", b"x b c d", b"b c d e"]
    text, first = substring.repeated(
        np.frombuffer(b"".join(texts), np.uint8), np.array([0, 7, 14, 21]), np.array([1, 2, 3]), 3)
    assert list(zip(text.tolist(), first.tolist())) == [(1, 1), (2, 0)]


def shingles_by_hand(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i: i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def classes_by_hand(rows, size, percent):
    sets = [shingles_by_hand(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    result = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        result.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(map(repr, result))


def near_copies(seed, count):
    """Groups of texts of 5 to 120 words with a few words changed, moved or dropped."""
    chosen, rows = random.Random(seed), []
    for i in range(count):
        group = chosen.randrange(6)
        words = prose(group, (5, 9, 14, 21, 60, 120)[group], 5000).split()
        for _ in range(chosen.choice((0, 0, 1, 1, 2, 4))):
            words[chosen.randrange(len(words))] = f"new{chosen.randrange(6)}"
        if chosen.random() < 0.3:
            words = words[: -1 - chosen.randrange(2)]
        rows.append((chosen.randrange(10_000), " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 85)])
def test_jaccard_classes_by_brute_force(spark, size, percent):
    rows = awkward() + near_copies(3, 150)
    found = jaccard.join(stored(spark, docs(spark, rows)), size=size, percent=percent)
    assert sorted(repr((r.id, r.n, r.component)) for r in found.collect()) == classes_by_hand(rows, size, percent)


def test_sketches_differ_no_more_than_sets():
    """Sets of 0 to 3,000 hashes, of one width and of others; a link is never dropped."""
    chosen = random.Random(5)
    for n in (0, 1, 2, 63, 64, 65, 130, 700, 3_000):
        one = {chosen.randrange(2 ** 64) for _ in range(n)}
        for changed in (0, 1, n // 20, n // 10, n):
            other = set(sorted(one)[: n - changed]) | {chosen.randrange(2 ** 64) for _ in range(chosen.randrange(changed + 1))}
            sets = [sorted(one), sorted(other)]
            sizes = np.array([len(s) for s in sets])
            sketched = jaccard.sketches(np.repeat([0, 1], sizes), np.array([v for s in sets for v in s], np.uint64), sizes).to_pylist()
            assert [bool(s) for s in sketched] == [bool(s) for s in sets]
            if all(sets):
                bits = int(jaccard.differing(sketched[:1], sketched[1:])[0])
                assert bits == int(jaccard.differing(sketched[1:], sketched[:1])[0])
                assert bits <= len(one ^ other) and bits % 2 == len(one ^ other) % 2
                batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "n_a": sizes[:1], "n_b": sizes[1:],
                                                    "sketch_a": sketched[:1], "sketch_b": sketched[1:]})
                kept, = jaccard._close(85)(iter([batch]))
                assert kept.num_rows or 100 * len(one & other) < 85 * len(one | other)


def test_texts_travel_only_where_sets_are_close(spark, monkeypatch):
    """Texts of three passages of eight, which meet in lists but link only with their copies, are not compared as texts."""
    passages = [prose(1_000 + i, 60, 10 ** 6) for i in range(8)]
    rows = [(i, " ".join(some)) for i, some in enumerate(itertools.combinations(passages, 3))]
    rows += [(100 + i, text + " end") for i, text in rows[:5]]
    compared, store = [], Scratch.store

    def counted(self, df, label, *given, **named):
        found = store(self, df, label, *given, **named)
        if label == "pairs":
            compared.append(found.count())
        return found

    monkeypatch.setattr(Scratch, "store", counted)
    found = jaccard.join(stored(spark, docs(spark, rows)))
    assert sorted(repr((r.id, r.n, r.component)) for r in found.collect()) == classes_by_hand(rows, 4, 85)
    assert 0 < sum(compared) <= 5


def test_one_row_of_each_class(spark):
    rows = awkward() + near_copies(4, 80)
    given = stored(spark, docs(spark, rows))
    kept = jaccard.one_of_each(given)
    assert kept.columns == given.columns
    ids = sorted(repr(r.doc_id) for r in kept.collect())
    by_class = {}
    for r in jaccard.join(given).collect():
        by_class.setdefault(r["class"], []).append(r.id)
    assert ids == sorted(repr(min((x for x in m if x is not None), default=None)) for m in by_class.values())


def test_subset_sizes():
    """c(n, m) is the smallest overlap of a link."""
    for percent in (80, 85):
        for n, m in itertools.product(range(1, 40), repeat=2):
            links = [c for c in range(min(n, m) + 1) if 100 * c >= percent * (n + m - c)]
            assert links == list(range(jaccard.shared(n, m, percent), min(n, m) + 1)) or not links
            assert bool(links) == (m in jaccard.partners(n, percent))
        assert 6 <= jaccard.boundary(1.0, percent) <= jaccard.boundary(1e6, percent)


def test_components(spark):
    chosen = random.Random(5)
    links = [(chosen.randrange(200), chosen.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    with Scratch(spark) as scratch:
        found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    root = list(range(400))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert found == {x: find(x) for x in range(400) if find(x) != x}
    with Scratch(spark) as scratch:
        assert components.components(spark.createDataFrame([], "a long, b long"), scratch).collect() == []


def words_of(text):
    import re

    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def hits_by_hand(rows, items, window):
    wanted = {}
    for item, text in items:
        own = words_of(text)
        size = min(window, len(own))
        for at in range(len(own) - size + 1) if own else ():
            wanted.setdefault(tuple(own[at: at + size]), set()).add(item)
    result = []
    for doc_id, text in rows:
        own, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in wanted}:
            for at in range(len(own) - size + 1):
                if (names := wanted.get(tuple(own[at: at + size]))) is not None:
                    hit.update(range(at, at + size))
                    found |= names
        result.append((doc_id, len(own), sorted(hit), sorted(map(repr, found))))
    return sorted(map(repr, result))


@pytest.mark.parametrize(("block", "vocabulary"), [(1_000_000, 1_000_000), (30, 1_000_000), (50, 3)])
def test_exact_phrases_by_brute_force(spark, block, vocabulary):
    """Also in many blocks, and with an index of all terms."""
    items = [(1, prose(1, 25)), (2, "one"), (3, None), (4, "..."), (5, prose(3, 12)), (5, prose(3, 12)), (6, "same same same"),
             (None, prose(2, 14)), (7, "not there at all")]
    rows = awkward()
    found = decontaminate.matches(
        docs(spark, rows), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, spans string"),
        block_words=block, vocabulary=vocabulary).collect()
    got = [(r.id, r.n_words, sorted({n for s in r.spans or () for n in range(s.begin, s.end)}), sorted(map(repr, r["items"])))
           for r in found]
    assert sorted(map(repr, got)) == hits_by_hand(rows, items, 10)
    assert all(r.n_hit == len({n for s in r.spans or () for n in range(s.begin, s.end)}) for r in found)


def test_proximity_and_nothing_to_find(spark):
    given = docs(spark, [(1, "a b c d e f"), (2, "a b x c d"), (3, "c b a"), (4, None)])
    item = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    hit = lambda **more: sorted(r.id for r in decontaminate.matches(given, item, **more).where("n_hit > 0").collect())
    assert hit() == [1]
    assert hit(slop=1) == [1, 2]
    nothing = decontaminate.matches(given, item.where("item_id > 1")).collect()
    assert sorted(r.id for r in nothing) == [1, 2, 3, 4] and all(r.n_hit == 0 for r in nothing)
    assert decontaminate.matches(docs(spark, []), item).collect() == []
    clean = decontaminate.without_matches(stored(spark, given), item)
    assert clean.columns == given.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]


def near_by_hand(words, phrase, slop):
    taken = set()
    for begin in range(-slop, len(words) + slop):
        places = [[p for p in range(max(0, begin + i - slop), min(len(words), begin + i + slop + 1)) if words[p] == w] for i, w in enumerate(phrase)]
        taken |= set(min((c for c in itertools.product(*places) if len(set(c)) == len(c)), default=()))
    return taken


@pytest.mark.parametrize("slop", [1, 2])
def test_proximity_does_not_depend_on_neighbours(spark, slop):
    chosen = random.Random(slop)
    texts = ["a x b y c", "x a b", "c", "a b", "a a", "a"] + [" ".join(chosen.choices("abcx", k=chosen.randrange(1, 9))) for _ in range(60)]
    phrases = ["a b c", "a a", "c b a b"]
    item = spark.createDataFrame(list(enumerate(phrases)), "item_id long, text string")
    expected = {}
    for i, text in enumerate(texts):
        hits = [near_by_hand(text.split(), p.split(), slop) for p in phrases]
        expected[i] = (set().union(*hits), {n for n, h in enumerate(hits) if h})
    assert 0 in expected[0][1]
    for neighbours in ("a a a a " * 40, "b " * 200, "c " * 200):
        given = docs(spark, [*enumerate(texts), (-1, neighbours)], parts=1)
        found = decontaminate.matches(given, item, slop=slop).where("id >= 0").collect()
        assert {r.id: ({p for s in r.spans or () for p in range(s.begin, s.end)}, set(r.items)) for r in found} == expected


def test_empty_tables(spark):
    empty = stored(spark, docs(spark, []))
    assert substring.dedupe(empty).collect() == []
    assert jaccard.join(empty).collect() == [] and jaccard.one_of_each(empty).collect() == []


@pytest.mark.parametrize("operator", ["near copies", "repeats", "passages", "counts", "model"])
def test_rows_are_met_again_when_files_are_split_anew(spark, operator):
    """Between the jobs of an operator Spark may plan other splits, as when an executor is lost."""
    import public_tokenizers

    from rollcall.llm import language_model, token_counts

    given = stored(spark, docs(spark, [(i, prose(i, 20 + 9 * i) + " " + prose(i % 7, 30)) for i in range(60)], parts=12))
    item = spark.createDataFrame([(1, prose(3, 30))], "item_id long, text string")
    run = {
        "near copies": lambda: jaccard.one_of_each(given), "repeats": lambda: substring.dedupe(given).select("doc.doc_id", "n_removed", "kept"),
        "passages": lambda: decontaminate.without_matches(given, item),
        "counts": lambda: token_counts.count(given, public_tokenizers.path("word_bpe_49k.json"), chunk_chars=400, overlap=100),
        "model": lambda: language_model.score(given, F.lit(True)).select("id", "n_tokens"),
    }[operator]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    expected = sorted(map(repr, run().collect()))
    try:
        found = run()
        for name in names:
            spark.conf.set(name, "1k")
        assert sorted(map(repr, found.collect())) == expected
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
