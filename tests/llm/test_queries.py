"""Every query against its SQL, and the pipeline against its stages by hand."""

from __future__ import annotations

from pathlib import Path

import pytest

from suite.compare import compare, connect
from suite.registry import Check

from rollcall.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), Check(QUERIES[name], SQL.get(name)), SF_DIR) is None


def test_pipeline(spark):
    import hashlib

    import corpus_pipeline as pipeline

    from .test_duplicates import hits_by_hand, kept_by_hand, shingles_by_hand
    from .helpers import stored

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, steps = docs.columns, []
    for _, stage in pipeline.STAGES:
        docs = stored(spark, stage(spark, docs, SF_DIR))
        steps.append(docs)
    good, single, cut, clean, ids = steps
    assert all(s.columns == columns for s in steps[:4])
    texts = [{r.doc_id: r.text for r in s.collect()} for s in steps[:4]]
    # Near copies: every text that went has a chain of links to one that stayed, and none that stayed links.
    sets = {i: shingles_by_hand(t, 5) for i, t in texts[0].items()}
    similar = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b)
    stays = set(texts[1])
    assert not any(similar(sets[a], sets[b]) for a in stays for b in stays if a < b)
    assert all(any(similar(sets[a], sets[b]) for b in sets if b != a) for a in set(texts[0]) - stays)
    # Repeats and benchmark passages by brute force.
    expected = kept_by_hand(sorted(texts[1].items()), 13)
    changed = {i: t for i, t in texts[2].items()}
    assert expected == sorted(repr((i, len((texts[1][i] or "").split()), len((texts[1][i] or "").encode().split()) - len((t or "").encode().split()),
                                    b" ".join((t or "").encode().split()).decode())) for i, t in changed.items())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    dirty = {h for h in texts[2] if "[]" not in hits_by_hand([(h, texts[2][h])], items, 10)[0]}
    assert set(texts[3]) == set(texts[2]) - dirty
    assert {r.doc_id: r.decoded_sha256 for r in ids.collect()} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts[3].items()}
    assert sorted(map(repr, pipeline.run(spark, SF_DIR).collect())) == sorted(map(repr, ids.collect()))


def test_stages_with_awkward_rows(spark, tmp_path):
    """An extra column that needs quoting, names that stages use inside, NULLs, repeated rows and an empty table."""
    import corpus_pipeline as pipeline

    from .helpers import awkward, stored

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    good = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    schema = "doc_id long, text string, n_chars long, `a-b` struct<`c-d`: int>, _quality string, row string, score int"
    odd = spark.createDataFrame([(i, t, len(t or ""), (1,), "x", "y", 2) for i, t in awkward()], schema)
    rows = odd.unionByName(good.select("doc_id", "text", "n_chars"), allowMissingColumns=True)
    for docs in (rows, rows.limit(0)):
        docs = stored(spark, docs)
        columns = docs.columns
        for _, stage in pipeline.STAGES[:-1]:
            docs = stored(spark, stage(spark, docs, str(tmp_path)))
            assert docs.columns == columns
        left = pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
        assert left == docs.count()
    assert docs.count() == 0
