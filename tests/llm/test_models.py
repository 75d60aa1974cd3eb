from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import language_model, quality, toxicity
from rollcall.llm.labelled import fold, sample

from .helpers import awkward, docs, prose, stored

def everyone():
    return F.lit(True)


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_folds_are_those_of_crc32(spark):
    rows = [(i,) for i in range(200)]
    found = spark.createDataFrame(rows, "doc_id long").select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in found)


def test_sample_is_bounded_and_skips_nulls(spark):
    given = docs(spark, [(i, "t") for i in range(30)])
    marks = labels(spark, [(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (4, 1)], "toxic")
    found = sample(given, marks, "toxic", F.col("doc_id") != 0, rows=10).collect()
    assert len({r.id for r in found}) == 10 and 0 not in {r.id for r in found}
    whole = {r.id: r.label for r in sample(given, marks, "toxic", everyone()).collect()}
    assert len(whole) == 30 and whole[4] == 1


def toxic_corpus(count):
    chosen = random.Random(1)
    rows, marks = [], []
    for i in range(count):
        parts = [prose(i * 5 + n, 12, 300) for n in range(4)]
        if i % 4 == 0:
            parts[chosen.randrange(4)] += " " + chosen.choice(("vilewort", "badword", "Vilewart"))
        rows.append((1_000 + i, ". ".join(parts)))
        marks.append((1_000 + i, int(i % 4 == 0)))
    return rows, marks


def test_toxic_sentences_are_found_from_document_labels(spark):
    rows, marks = toxic_corpus(240)
    given = stored(spark, docs(spark, rows + awkward()))
    model = toxicity.fit(given, labels(spark, marks, "toxic"), fold("doc_id", 5) != 0)
    texts = dict(rows)
    held = [r for r in toxicity.score(given, model).collect() if r.id in texts and len(texts[r.id]) > 100 and zlib.crc32(str(r.id).encode()) % 5 == 0]
    assert held and all((r.score >= 0.5) == (r.id % 4 == 0) for r in held)
    for r in held:
        for s in r.sentences:
            assert "v" in texts[r.id].encode()[s.begin: s.end].decode().lower() or "badword" in texts[r.id].encode()[s.begin: s.end].decode()
    empty = [r.score for r in toxicity.score(docs(spark, [(1, None), (2, ""), (3, " \n")]), model).collect()]
    assert empty == [0, 0, 0]
    assert toxicity.score(docs(spark, []), model).collect() == []


@pytest.mark.parametrize("marks", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_without_both_kinds_of_labels(spark, marks):
    given = docs(spark, awkward())
    model = toxicity.fit(given, labels(spark, marks, "toxic"), everyone())
    assert all(r.score < 1e-9 for r in toxicity.score(given, model).collect())
    trees = quality.fit(given, labels(spark, marks, "quality"), everyone())
    assert all(r.score == 0.5 for r in quality.score(given, trees).collect())


def test_quality_on_held_out_documents(spark):
    rows = [(i, prose(i, 60) if i % 3 else prose(i, 40).upper().replace(" ", "!! ")) for i in range(300)]
    given = stored(spark, docs(spark, rows + [(1000, None), (1001, "")]))
    marks = labels(spark, [(i, int(i % 3 > 0)) for i in range(300)], "quality")
    model = quality.fit(given, marks, fold("doc_id", 4) != 2)
    found = quality.score(given, model)
    assert found.columns == [*[c for c in given.columns if c != "score"], "score"]
    got = {r.doc_id: r.score for r in found.collect()}
    assert all((got[i] >= 0.7) == (i % 3 > 0) for i in range(300)) and all(0 <= s <= 1 for s in got.values())


def test_trees_descend_like_a_loop():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = quality.grow(x, y, trees=20, depth=3)
    found = model.scores(x)
    for row, score in list(zip(x, found))[:50]:
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((found > 0.5) == (y > 0)).mean() > 0.95


def texts_for_model(count):
    chosen = random.Random(3)
    chains = {w: [chosen.randrange(40) for _ in range(3)] for w in range(40)}
    rows = []
    for i in range(count):
        word, own = chosen.randrange(40), []
        for _ in range(chosen.randrange(5, 60)):
            own.append(f"W{word}")
            word = chosen.choice(chains[word])
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("hot", [language_model.HOT, 20])
def test_language_model(spark, hot):
    """Base scores by hand; the model beats them on documents it has not seen, also with contexts split over buckets."""
    rows = texts_for_model(200) + awkward()
    given = stored(spark, docs(spark, rows))
    found = language_model.score(given, fold("doc_id", 10) != 0, hot=hot, bucket_bytes=3_000).collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [(i, [*(t or "").encode().lower().split(), b"\0"]) for i, t in rows]
    counts = Counter(w for i, t in tokens if not held(i) for w in t)
    total, known = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (known + 1))) for w in t)
    expected = sorted((repr(i), len(t), sum(counts[w] > 0 for w in t), total, round(base(t), 6)) for i, t in tokens)
    assert sorted((repr(r.id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    unseen = [r for r in found if held(r.id) and r.id is not None and r.id < 200]
    assert sum(r.score for r in unseen) > 0.8 * sum(r.base_score for r in unseen)
    again = language_model.score(given, fold("doc_id", 10) != 0, hot=hot, bucket_bytes=3_000).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_language_model_has_one_parent_over_the_corpus(spark):
    """A pair is one customer of the parent in however many segments, and the parent is not that of a bucket."""
    given = docs(spark, texts_for_model(200))
    together, apart = (stored(spark, given.repartition(n)) for n in (1, 6))
    scores = lambda df, size: {r.id: r.score for r in language_model.score(df, fold("doc_id", 10) != 0, bucket_bytes=size).collect()}
    whole = scores(together, 1 << 22)
    assert scores(apart, 1 << 22) == pytest.approx(whole, abs=1e-6)
    cut = scores(apart, 2_000)
    assert max(abs(cut[i] - whole[i]) / (1 + abs(whole[i])) for i in whole) < 0.03


def test_probabilities_after_a_word_sum_to_one(spark):
    """One word texts: all words that can begin a text, and one unknown for all others."""
    rows = [(i, f"w{i % 7}") for i in range(60)]
    probes = [(1000 + i, f"w{i}") for i in range(7)] + [(2000, ""), (2001, "never")]
    given = stored(spark, docs(spark, rows + probes))
    scored = {r.id: r for r in language_model.score(given, F.col("doc_id") < 1000).collect()}
    after = {r.id: 10 ** r.score for r in scored.values() if r.id >= 1000}
    # The end follows each known word in all texts, so dividing by its share gives the share of the word.
    assert after[2000] < 0.2 and sum(after.values()) < 1.0
    assert sum(after[1000 + i] for i in range(7)) > 0.6


def test_corner_tables(spark):
    assert language_model.score(docs(spark, []), everyone()).collect() == []
    nobody = language_model.score(stored(spark, docs(spark, awkward())), F.lit(None).cast("boolean")).collect()
    assert len(nobody) == len(awkward()) and all(math.isfinite(r.score) and r.train_tokens == 0 for r in nobody)


def test_tables_are_seated_within_bounds():
    random_ = np.random.Generator(np.random.PCG64(1))
    count = np.array([0, 1, 2, 5, 400, 100_000])
    for pull in (1e-9, 1.0, 1e9):
        tables = language_model.seated(random_, count, np.full(6, pull), 0.5)
        assert (tables <= count).all() and (tables >= np.minimum(count, 1)).all()
    assert language_model.seated(random_, count, np.full(6, 1e9), 0.5)[-1] > 90_000


def test_chances_like_a_loop_from_given_tables():
    """Predictive probabilities of fixed seatings, one context split over buckets, against the formula pair by pair."""
    contexts, runs = np.array([5, 9, 12], "<u8"), np.array([2, 1, 3], "<i4")
    word, count, tables = [0, 2, 1, 0, 1, 3], [4, 1, 7, 2, 0, 3], [2, 1, 3, 1, 0, 2]
    pairs = language_model.Pairs(language_model.packed(
        contexts, runs, np.array(word, "<i4"), np.array(count, "<i4"), np.array([0, 4], "<i8")))
    customers, seats = np.array([4, 6, 1, 2]), np.array([2, 3, 1, 1])
    answers = [{"parent": p, "data": language_model.packed(customers[a:b].astype("<i8"), seats[a:b].astype("<i8"))}
               for p, (a, b) in enumerate([(0, 3), (3, 4)])]
    state = language_model.Sweep(13, 7, {12: 10}, {12: 40}, 0.6, 0.3, 5)
    parent = state.parent(answers[::-1])
    found = pairs.chances(np.array(tables), state.split, state.visits, parent, 0.6)
    owner = [0, 0, 1, 2, 2, 2]
    for i, mine in enumerate(owner):
        visits = 40 if mine == 2 else sum(c for c, o in zip(count, owner) if o == mine)
        total = 10 if mine == 2 else sum(t for t, o in zip(tables, owner) if o == mine)
        above = (customers[word[i]] - 0.3 * seats[word[i]] + (1 + 0.3 * 7) / 6) / (1 + 13)
        assert found[i] == pytest.approx((max(count[i] - 0.6 * tables[i], 0) + (1 + 0.6 * total) * above) / (1 + visits))
