"""Documents on their way to a training corpus: five stages, each of which works on all that the one before kept.

A stage begins when the result of the one before is written, and deletes the intermediate tables which that one needed. NULL and
empty texts, repeated rows, ties and clashing column names are treated as the operators state; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import bpe, decontaminate, jaccard, quality, substring
from rollcall.llm.labelled import fold
from rollcall.llm.scratch import folders, release
from rollcall.session import fresh_dir

#: Documents scored lower are rejected.
LEAST_QUALITY = 0.7
SHINGLE, PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders that the last stage of each application still needs.
_needed: dict[str, list[str]] = {}


def _after_the_last(stage: Stage) -> Stage:
    """``stage``, after the folders of the one before are gone, unless its result is read from them."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        release(spark, _needed.pop(application, []), docs)
        before = folders(spark)
        result = stage(spark, docs, sf_dir)
        _needed[application] = [path for path in folders(spark) if path not in before]
        return result

    return run


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from three quarters of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, fold("doc_id", 4) != 2)
    name = next(n for n in ("_quality" + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    scored = quality.score(docs, model, output=name)
    return scored.where(F.col(name) >= LEAST_QUALITY).select(*[f"`{c}`" for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near copies."""
    return jaccard.one_of_each(docs, size=SHINGLE, percent=PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of words that an earlier document has; untouched texts stay as they are."""
    found = substring.dedupe(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("doc.n_chars"))}
    return found.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_matches(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each text, and the digest of the bytes they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [(name, _after_the_last(stage)) for name, stage in (
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
)]

# Trees, classes of links and BPE are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = fresh_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
